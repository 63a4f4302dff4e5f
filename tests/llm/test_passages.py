"""Runs of sentences that repeat, against a plain version."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from tallyproof.llm import passage_dedup

SCHEMA = "doc_id long, text string, n_chars long, t string"


def plain(rows, least):
    """Of rows in order: each text without the sentences of runs that start earlier too."""
    found, first = [], {}
    for n, (_, t) in enumerate(rows):
        units = [u for line in (t or "").split("\n") for u in re.split(r"(?<=[.!?] )", line)]
        words = [[w for w in re.split(r"[\x20\x09-\x0D]+", u.lower()) if w] for u in units]
        some = [i for i, w in enumerate(words) if w]
        runs = set()
        for i in range(len(some)):
            for j in range(i + 2, len(some) + 1):
                inner = [len(words[x]) for x in some[i:j]]
                if sum(inner) >= least and (sum(inner[1:]) < least or sum(inner[:-1]) < least):
                    runs.add((some[i], some[j - 1] + 1))
        of = {(a, b): tuple(" ".join(w) for w in words[a:b] if w) for a, b in runs}
        for (a, _), text in of.items():
            first[text] = min((n, a), first.get(text, (n, a)))
        found.append(of)
    out = []
    for n, (k, t) in enumerate(rows):
        gone = {i for (a, b), text in found[n].items() if first[text] != (n, a) for i in range(a, b)}
        place, lines = 0, []
        for line in (t or "").split("\n"):
            units = re.split(r"(?<=[.!?] )", line)
            left = "".join(u for i, u in enumerate(units, place) if i not in gone)
            if left or not gone & set(range(place, place + len(units))):
                lines.append(left)
            place += len(units)
        out.append((k, None if t is None else "\n".join(lines)))
    return out


def kept(spark, rows, **more):
    docs = spark.createDataFrame([(k, t, 7, "x") for k, t in rows], SCHEMA).repartition(3)
    done = passage_dedup.keep_first(docs, **more)
    assert done.columns == docs.columns and done.filter("n_chars <> 7 and n_chars <> length(text)").count() == 0
    return sorted(((r.doc_id, r.text) for r in done.collect()), key=str)


def test_runs_of_short_sentences(spark, monkeypatch):
    rng = random.Random(3)
    sentence = lambda: " ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(rng.choice([1, 2, 3, 4, 9]))) + rng.choice(".!?")
    pool = [sentence() for _ in range(25)]
    passages = [[sentence() for _ in range(rng.randrange(2, 9))] for _ in range(8)]
    rows = []
    for i in range(50):
        parts = [rng.choice(pool) for _ in range(rng.randrange(0, 6))] + rng.choice(passages) + [rng.choice(pool) for _ in range(rng.randrange(0, 6))]
        rows.append((i, "".join(p + rng.choice([" ", " ", "\n", "\n\n", "  ", " \n"]) for p in parts)))
    rows += [(100, None), (101, ""), (102, "is. " * 40), (103, rows[3][1].upper()), (104, "\n\n")]
    want = sorted(plain(rows, 6), key=str)
    assert want != sorted(rows, key=str)
    assert kept(spark, rows, least=6) == want
    monkeypatch.setattr(passage_dedup, "CHUNK", 200)
    assert kept(spark, rows, least=6) == want


def test_repeated_rows_and_null_keys(spark):
    t = "One two. Three four five. Six."
    assert kept(spark, [(1, t), (1, t), (2, "Zero. " + t), (None, t + " End")], least=5) == sorted([(1, ""), (1, ""), (2, "Zero. One two. Three four five. Six."[:6]), (None, t + " End")], key=str)
    assert kept(spark, []) == []


def test_pipeline_cuts_passages_of_short_sentences(spark, sf):
    import corpus_pipeline

    rng = random.Random(4)
    text = lambda n: " ".join(" ".join(f"w{rng.randrange(10**6)}" for _ in range(5)) + "." for _ in range(n))
    passage = text(12)
    rows = [(i, f"{text(9)} {passage} {text(9)}") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text")})
    now = docs
    names = [name for name, _ in corpus_pipeline.STAGES]
    for _, stage in corpus_pipeline.STAGES[names.index("n-gram Jaccard join") + 1 : -1]:
        now = stage(spark, now, sf)
    got = {r.doc_id: r.text for r in now.collect()}
    assert got == {0: rows[0][1]} | {i: rows[i][1].replace(passage + " ", "") for i in (1, 2)}


def plain_words(rows, size):
    """Of rows in order: each text without the words of runs that start earlier too, and without lines that lose all of theirs."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)) for _, t in rows]
    first, out = {}, []
    for n, w in enumerate(words):
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i : i + size]), (n, i))
    for n, (k, t) in enumerate(rows):
        gone = {j for i in range(len(words[n]) - size + 1) if first[tuple(words[n][i : i + size])] != (n, i) for j in range(i, i + size)}
        at, lines = 0, []
        for line in (t or "").split("\n"):
            parts = re.findall(r"^[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", line)
            left, had = "", False
            for part in parts:
                if part.strip(" \t\n\x0b\f\r"):
                    had |= at in gone
                    left += "" if at in gone else part
                    at += 1
                else:
                    left += part
            if not had or left.strip(" \t\n\x0b\f\r"):
                lines.append(left)
        out.append((k, None if t is None else "\n".join(lines)))
    return out


def test_passages_of_words(spark, monkeypatch):
    rng = random.Random(5)
    space = lambda: rng.choice([" ", " ", " ", "  ", "\n", " \n\n", "\t", "\n "])
    text = lambda n: [rng.choice("abcdefghijkl") * rng.randrange(1, 4) + rng.choice(["", "", "", ".", ","]) for _ in range(n)]
    passages = [text(n) for n in (6, 7, 8, 9, 13, 14, 20, 40, 60)]
    rows = []
    for i in range(60):
        words = text(rng.randrange(0, 12)) + [w.upper() if i % 7 == 0 else w for w in rng.choice(passages)] + text(rng.randrange(0, 12))
        rows.append((i, "".join(w + space() for w in words)))
    rows += [(100, None), (101, ""), (102, "is " * 40), (103, "a b c " * 30), (104, "\n\n"), (105, "É " * 9), (106, "é " * 9), (107, rows[3][1])]
    for size in (7, 8):
        want = sorted(plain_words(rows, size), key=str)
        assert want != sorted(rows, key=str)
        assert kept(spark, rows, least=10**6, passage=size) == want
    monkeypatch.setattr(passage_dedup, "CHUNK", 200)
    monkeypatch.setattr(passage_dedup, "SLICE", 90)
    assert kept(spark, rows, least=10**6, passage=8) == want


def test_pipeline_cuts_passages_within_a_sentence(spark, sf):
    import corpus_pipeline

    rng = random.Random(6)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage, short = text(51), text(50)
    rows = [(i, f"{text(9)} {passage} {text(9)}.") for i in range(3)] + [(i, f"{text(9)} {short} {text(9)}.") for i in (3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text")})
    got = {r.doc_id: (r.text, r.n_chars) for r in dict(corpus_pipeline.STAGES)["passage dedup"](spark, docs, sf).collect()}
    want = {k: t.replace(passage + " ", "") if k in (1, 2) else t for k, t in rows}
    assert got == {k: (t, len(t)) for k, t in want.items()}


def test_words_and_sentences_together():
    t = "One two. Three\n four five. Six.\n\nSeven eight "
    assert passage_dedup.without(t, set(), [(1, 4)]) == "One \n five. Six.\n\nSeven eight "
    assert passage_dedup.without(t, {3}, [(0, 3)]) == " four five. \n\nSeven eight "
    assert passage_dedup.without(t, {2, 3}, [(0, 3), (6, 8)]) == ""


def test_few_runs_are_hashed_where_nothing_repeats(spark, monkeypatch):
    rng = np.random.default_rng(7)
    held = [" ".join(map(str, rng.integers(0, 10**9, 4000))) for _ in range(60)]
    rows = spark.createDataFrame([(i, 0, t) for i, t in enumerate(held + held[:45])], "k long, h long, t string")
    wanted = {}
    kept_filter = passage_dedup._filter_of
    monkeypatch.setattr(passage_dedup, "_filter_of", lambda found: wanted.setdefault("bits", kept_filter(found)))
    passage_dedup.repeats(rows, 4, 13, 51)
    width, bits = wanted["bits"]
    words, bounds = passage_dedup._worded(held)
    first = passage_dedup._around(words, bounds, 51, width, np.frombuffer(bits, np.uint8))[1]
    assert set(range(45 * 4000 - 50)) - set(first.tolist()) <= {int(b) - 1 - i for b in bounds[1:] for i in range(50)}
    assert (first >= bounds[45]).sum() < 0.03 * (bounds[-1] - bounds[45])

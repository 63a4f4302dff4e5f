"""Packing, piece sampling, media, quality rules and extraction against plain versions."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyproof.llm import matroska, packing, piece_sampling, quality_rules, queries, style_tree

ODD = ["", " ", "\n", "a", "a  b", " x y", "x\n\n y", "x \ny z w", "a\tb c d", "é è b  \n", "<|endoftext|> hi", "x\r\ny z w", "don't we 'll 's 12 3a ___ !!", "日本語 𝄞 ½ ²x", "a\0b \0c", "▁x ▁▁", "y" * 3000, " a b"]
SCHEMA = "doc_id long, text string, k string, n int, cls string, h string, _row string, h_2 int"


def frame(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "k", 1, "c", "h", "r", 2) for i, t in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def bpe():
    return queries.tokenizer("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference(bpe):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_encoder_gives_the_tokenizers_ids(bpe, reference):
    texts = [*ODD, None, " ".join(ODD)]
    assert [x.tolist() for x in packing.Encoder(bpe).encode(texts)] == [reference(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab '1,.é\n\t\0  日", max_size=30), max_size=6))
def test_encoder_on_any_text(bpe, reference, texts):
    assert [x.tolist() for x in packing.encoder(bpe).encode(texts)] == [reference(t) for t in texts]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=60))
def test_best_fit_decreasing(lengths):
    placed, fill = packing.best_fit(lengths, 16)
    room: list[int] = []
    want = [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        open_ = [r for r in room if r >= lengths[i]]
        at = min(r for r in open_) if open_ else None
        if at is None:
            room.append(16 - lengths[i])
        else:
            room[room.index(at)] = at - lengths[i]
    assert sorted(16 - f for f in fill) == sorted(room)
    assert all(sum(lengths[i] for i in range(len(lengths)) if placed[i] == w) == f <= 16 for w, f in enumerate(fill))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=40))
def test_pieces_cover_each_id_once_without_padding(sizes):
    docs = [(i, np.arange(n, dtype=np.uint32)) for i, n in enumerate(sizes)]
    rows = list(packing.pack_split(iter(docs), 16))
    fill, held = collections.defaultdict(list), collections.defaultdict(list)
    for key, start, length, crc, n, seq, offset in rows:
        assert crc == zlib.crc32(np.arange(start, start + length, dtype="<u4").tobytes()) and n == sizes[key]
        held[key] += range(start, start + length)
        fill[seq].append((offset, length))
    assert all(sorted(held[i]) == list(range(n)) for i, n in enumerate(sizes))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 16 or at < 16 and at & (at - 1) == 0


def test_pack_query_shape(spark, bpe, reference):
    texts = [None, "", *ODD, "word " * 5000]
    got = packing.pack(frame(spark, texts), bpe).collect()
    tokens = {r.doc_id: r.doc_tokens for r in got}
    assert tokens == {i: len(reference(t)) + 1 for i, t in enumerate(texts)}
    assert packing.pack(frame(spark, []), bpe).count() == 0


@pytest.mark.parametrize("kind", ["int", "string", "date", "decimal(9,2)", "struct<a:int>"])
def test_pack_takes_any_key(spark, bpe, kind):
    made = "named_struct('a', 1)" if "struct" in kind else "date'2020-01-02'" if kind == "date" else f"cast(7 as {kind})"
    docs = spark.sql(f"select {made} as `a key`, 'one two' as text, 3 as length union all select cast(null as {kind}), null, 4")
    got = packing.pack(docs, bpe, key="a key")
    assert dict(got.dtypes)["a key"] == kind and {r.doc_tokens for r in got.collect()} == {1, 3}


@pytest.fixture(scope="module")
def lattices():
    return piece_sampling.Lattices(queries.tokenizer("piece_bpe_32k.model"), 1.0)


def test_sampling_is_lossless(lattices):
    ids = lattices.encode(list(range(len(ODD))), ODD, 0)
    assert [lattices.decode(i.tolist()) for i in ids] == ODD


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abt he▁\n日\t ", max_size=40))
def test_any_text_comes_back(lattices, text):
    assert lattices.decode(lattices.encode([7], [text], 3)[0].tolist()) == text


def test_sampling_does_not_depend_on_the_batch(lattices):
    texts = ["the cat sat on", "a word", "the cat sat on"]
    alone = [lattices.encode([k], [t], 5)[0].tolist() for k, t in enumerate(texts)]
    assert [x.tolist() for x in lattices.encode([0, 1, 2], texts, 5)] == alone
    fresh = piece_sampling.Lattices(queries.tokenizer("piece_bpe_32k.model"), 1.0)
    assert [x.tolist() for x in fresh.encode([2, 0], [texts[2], texts[0]], 5)] == [alone[2], alone[0]]
    assert any(lattices.encode([0], [texts[0]], s)[0].tolist() != alone[0] for s in range(20))


def test_samples_follow_the_weights(lattices):
    word, n = "▁the▁cat", 20_000
    seen = collections.Counter(tuple(x.tolist()) for x in lattices.encode(list(range(n)), ["the cat"] * n, 1))

    def all_cuts(at):
        if at == len(word):
            yield (), 1.0
        for end in range(at + 1, len(word) + 1):
            if word[at:end] in lattices.piece:
                ident, weight = lattices.piece[word[at:end]]
                for rest, w in all_cuts(end):
                    yield (ident, *rest), weight * w

    weights = dict(all_cuts(0))
    total = sum(weights.values())
    assert set(seen) <= set(weights)
    for cut, w in sorted(weights.items(), key=lambda x: -x[1])[:4]:
        assert abs(seen[cut] / n - w / total) < 0.02


def test_piece_query(spark):
    model = queries.tokenizer("piece_bpe_32k.model")
    docs = frame(spark, [None, *ODD])
    rows = piece_sampling.encode(docs, model, digest=True).collect()
    assert all(r.lossless for r in rows) and rows[0].n_pieces == 0
    back = piece_sampling.decode(piece_sampling.encode(docs, model), model).orderBy("doc_id").collect()
    assert [r.text for r in back] == ["", *ODD]


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 511, 512, 513, 4096, 5000, 70_000, 300_000])
def test_media_goes_round(n):
    payload = matroska.payload_of("z" * n)
    media = matroska.mux(payload)
    packets, cues = matroska.demux(media)
    assert b"".join(media[a : a + k] for _, _, a, k, _, _ in packets) == payload and len(payload) % 64 == 0 and payload
    assert len({p[5] for p in packets}) == len(cues) and {c[2] for c in cues} == {p[5] for p in packets}
    assert [p[1] for p in packets] == [i * 64 for i in range(len(packets))]


@pytest.mark.parametrize("scheme", [1, 2, 3])
@settings(max_examples=40, deadline=None)
@given(sizes=st.lists(st.integers(0, 70_000), min_size=2, max_size=6))
def test_lacing(scheme, sizes):
    sizes = [sizes[0]] * len(sizes) if scheme == 2 else sizes
    frames = [bytes(n) for n in sizes]
    body = matroska.laced(frames, scheme)
    assert [b - a for a, b in matroska.split_lacing(body, 0, len(body), scheme)] == sizes


def test_cluster_of_unknown_size():
    media = matroska.mux(b"q" * 64)
    at = media.index(bytes.fromhex("1f43b675")) + 4
    unknown = media[:at] + b"\xff" + media[at + 1 :]
    assert matroska.demux(unknown)[0] == matroska.demux(media)[0]
    with pytest.raises(ValueError):
        matroska.demux(media[:-3])


def test_media_query(spark):
    rows = matroska.media_columns(frame(spark, [None, "", "é" * 70, "é" * 70]), keep_media=True)
    got = rows.orderBy("doc_id").collect()
    assert [(r.n_bytes, r.payload_bytes) for r in got] == [(0, 64), (0, 64), (140, 192), (140, 192)]
    assert got[0].payload_sha256 == hashlib.sha256(bytes(64)).hexdigest() and got[0].tail_crc32 == zlib.crc32(bytes(64))
    assert got[2].asDict() | {"doc_id": 0} == got[3].asDict() | {"doc_id": 0}
    assert matroska.packet_table(rows).groupBy("doc_id").agg(F.sum("length").alias("n")).orderBy("doc_id").collect()[2].n == 192


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_rules(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_quality_rules(spark):
    texts = [None, *ODD, "a b c a b c a b", "x y z " * 40, " ".join(f"w{i}" for i in range(60)) + "\n" + " ".join(f"w{i}" for i in range(20, 25)), "the of and to " + " ".join(f"w{i}" for i in range(60)), "#a $b\n#a $b\n \n\n", "\x0b\x0c a\x1cb"]
    rows = quality_rules.judge(frame(spark, texts)).orderBy("doc_id").collect()
    assert [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows] == [plain_rules(t) for t in texts]
    assert all(not (r.kept and r.base_failed) for r in rows) and any(r.kept for r in rows)
    kept = quality_rules.keep(frame(spark, texts))
    assert kept.columns == frame(spark, []).columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.kept}
    assert quality_rules.judge(frame(spark, [])).count() == 0


def test_quality_rules_run_no_python(spark):
    plan = quality_rules.judge(frame(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


PAGES = [
    ("<body><nav><a>Home</a></nav><article><h1>T &amp; t</h1><p>One<p>two  \n three<br>four</p><aside>x</aside></article><footer>f</footer>", "T & t\nOne\ntwo three four"),
    ("<body><header>H</header><div class='menu'>m</div><div><p>One <b>bold</b><p>two <span class=ad>x</span>three</div><div id=comments><p>c</p></div><ul><li>a<li>b</ul><!-- x <p>no</p>", "One bold\ntwo three\na\nb"),
    ("<script>var a='<p>no</p>'</script><style>p{}</style><p>yes</p><form><input value='x'>q</form>", "yes"),
    ("plain &lt;text&gt; 1 < 2", "plain <text> 1 < 2"),
    ("<main><p>a</p></main><p>outside</p>", "a"),
    ("<p hidden>no</p><p>yes", "yes"),
    ("<div role=navigation>no</div><table><tr><td>a<td>b</table>", "a\nb"),
    (None, ""),
    ("", ""),
]


def test_extraction(spark):
    df = spark.createDataFrame([(i, f"http://h{i}.example/x", h) for i, (h, _) in enumerate(PAGES)], "page_id long, url string, html string")
    rows = style_tree.extract(df).orderBy("page_id").collect()
    assert [r.text for r in rows] == [t for _, t in PAGES] and [r.n_chars for r in rows] == [len(t) for _, t in PAGES]


@pytest.mark.parametrize("broadcast", [100, 0])
def test_branches_that_all_pages_of_a_host_repeat_are_cut(spark, broadcast):
    page = lambda i: f"<body><div class=x7><p>Buy now</p></div><div class=body><p>Story {i} of many</p></div></body>"
    df = spark.createDataFrame([(i, "http://a.example/" if i < 8 else None, page(i)) for i in range(10)], "page_id long, url string, html string")
    rows = {r.page_id: r.text for r in style_tree.extract(df, broadcast_paths=broadcast).collect()}
    assert rows == {i: f"Story {i} of many" if i < 8 else f"Buy now\nStory {i} of many" for i in range(10)}


NAMED = [
    ("<nav>n</nav><article class='post has-comments'><h1>T</h1><p>One</p></article>", "T\nOne"),
    ("<article class='hentry category-social'><p>One</p><div class=share>Share it</div></article>", "One"),
    ("<main class='with-sidebar'><p>One</p></main><div class=sidebar>s</div>", "One"),
    ("<div id='content-with-sidebar'><p>A long story of the day</p><div class=sidebar>s</div></div><div class=menu>m</div>", "A long story of the day"),
    ("<div class='page-footer-fixed'><article><p>One</p></article></div>", "One"),
    ("<article><div class='entry-header'><h1>Title</h1></div><p>One two three four</p></article>", "Title\nOne two three four"),
    ("<article><div class='promo box'><h1>Title</h1></div><p>One two three four</p></article>", "Title\nOne two three four"),
    ("<article><p>A story with its end</p></article><div id=comments><article class='comment'><p>so it is</p></article></div>", "A story with its end"),
    ("<div><p>Short</p></div><div class=comments><p>longer than the text</p></div>", "Short"),
    ("<div class='post has-comments'>One</div><div class='post category-social'>Two</div><div class='post related-b'>Six</div><div class=ad>x</div>", "One\nTwo\nSix"),
    ("<p>One <span class=ad>x</span>two <span class='promo text'>and <b>three</b></span></p>" + "<p>four</p>" * 9, "\n".join(["One two", *["four"] * 9])),
    ("<p><span class='with-sidebar'>All of the text is in here</span></p>", "All of the text is in here"),
]


@pytest.mark.parametrize(("html", "text"), NAMED)
def test_names_are_only_a_prior(html, text):
    assert style_tree.Page(html).text(frozenset()) == text


def test_the_tree_cuts_what_names_spare(spark):
    page = lambda i: f"<div class='promo-wide'><p>The same long words on all the pages</p></div><div><p>Story {i}</p></div>"
    df = spark.createDataFrame([(i, "http://a.example/", page(i)) for i in range(8)], "page_id long, url string, html string")
    assert style_tree.Page(page(0)).text(frozenset()).startswith("The same")
    assert {r.page_id: r.text for r in style_tree.extract(df).collect()} == {i: f"Story {i}" for i in range(8)}


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<div class='content with-sidebar'><article>A b</article></div>", "A b"),
        ("<div class='page has-sidebar'><p>A b</p></div>", "A b"),
        ("<article><div class='entry-header'><h1>T</h1></div><p>x</p></article>", "T\nx"),
        ("<article><p>a</p><section class='related-work'><p>b</p></section></article>", "a\nb"),
        ("<div class='post-comments-open'><p>a</p></div><p>b</p>", "a\nb"),
    ],
)
def test_parts_of_names_say_nothing(html, text):
    assert style_tree.Page(html).text(frozenset()) == text


@pytest.mark.parametrize("source", ["<div>a" * 170_000, "<div class=x>" * 80_000 + "a</p>" * 10, "<span class=ad>a" * 60_000, "<span class=ad>a" * 30_000 + "</span>" * 30_000, "</b>" * 250_000, "<b id=q>" * 120_000, "<p>" + "word " * 200_000])
def test_time_grows_with_the_length(source):
    import time

    began = time.process_time()
    page = style_tree.Page(source)
    page.text(frozenset())
    assert sum(1 for _ in page.votes()) <= style_tree.LEVELS * len(page.blocks) * 2 + 2
    assert time.process_time() - began < 8


def plain_importance(pages):
    """Importance of each (host, path) from the definition: entropies over the pages that have it."""
    import math

    layouts, blocks, out = collections.defaultdict(list), collections.defaultdict(list), {}
    for host, source in pages:
        for path, feature, is_text, _ in style_tree.Page(source).votes():
            (blocks if is_text else layouts)[host, path].append(feature)
    for at, seen in layouts.items():
        m = len(seen)
        if m < 4:
            continue
        log = lambda x: math.log(x, m)
        shown = -sum(n / m * log(n / m) for n in collections.Counter(seen).values())
        each = [-sum(1 / n * log(1 / n) for _ in range(n)) for n in collections.Counter(blocks[at]).values()]
        told = 1 - sum(each) / len(each)
        weight = 0.9 ** len(set(seen))
        out[at] = (1 - weight) * shown + weight * told
    return out


def test_importance_against_its_definition(spark, sf):
    import random

    rng = random.Random(1)
    pages = [(f"h{i % 3}.example", "".join(rng.choice(["<p>one</p>", f"<p>t{i}</p>", "<div class=q><p>buy</p></div>", "<ul><li>a<li>b</ul>", f"<section><p>s{i % 4}</p></section>", "<nav>n</nav>"]) for _ in range(6))) for i in range(60)]
    docs = spark.createDataFrame([(i, f"http://{h}/x", s) for i, (h, s) in enumerate(pages)], "page_id long, url string, html string")
    got = {(r.host, r.path): r.importance for r in style_tree.low_branches(docs, threshold=2.0, outside=2.0).collect()}
    want = plain_importance(pages)
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-6 for x in want)
    docs = spark.read.parquet(f"{sf}/pages.parquet")
    assert style_tree.low_branches(docs, outside=0.25).count() == sum(1 for x in plain_importance([(r.host, r.html) for r in docs.select(style_tree.host_of(F.col("url")).alias("host"), "html").collect()]).values() if round(x, 9) < 0.25)


def test_the_tree_decides_on_sites_with_pages_enough(spark):
    import os

    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("test tables are not here")
    docs = spark.read.parquet(f"{folder}/pages.parquet").withColumn("host", style_tree.host_of(F.col("url")))
    cut = collections.defaultdict(set)
    for r in style_tree.low_branches(docs).collect():
        cut[r.host].add(r.path)
    changed = 0
    for r in docs.collect():
        page = style_tree.Page(r.html)
        low = page.low(cut[r.host])
        changed += any(low[b] for _, b in page.blocks)
    assert changed > 0


def test_extraction_of_odd_tables(spark):
    kinds = "page_id long, url string, html string, host string, path string, text string"
    page = "<main><p>é  a</p></main>"
    rows = [(1, None, page), (1, None, page), (None, "http://a.example/", page), (2, "nonsense", None), (3, "http://A.example:80/", "<p>" + "long word " * 100_000)]
    got = style_tree.extract(spark.createDataFrame([(*r, "h", "p", "t") for r in rows], kinds))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((str(r.page_id), r.n_chars) for r in got.collect()) == [("1", 3), ("1", 3), ("2", 0), ("3", 999_999), ("None", 3)]
    for broadcast in (10, 0):
        assert style_tree.extract(spark.createDataFrame([], kinds), broadcast_paths=broadcast).count() == 0


def plain_walk(data, at, end, masters):
    """EBML by its definition: (id, body) of all elements whose size is known."""
    while at < end:
        lead = next(i for i in range(8) if data[at] >> (7 - i) & 1)
        ident = data[at : at + lead + 1].hex()
        at += lead + 1
        wide = next(i for i in range(8) if data[at] >> (7 - i) & 1)
        size = int.from_bytes(data[at : at + wide + 1], "big") & ((1 << 7 * (wide + 1)) - 1)
        at += wide + 1
        yield ident, data[at : at + size]
        if ident in masters:
            yield from plain_walk(data, at, at + size, masters)
        at += size


@pytest.mark.parametrize("n", [0, 700, 9000, 70_000])
def test_media_against_a_plain_reader(n):
    payload = matroska.payload_of("ab\u00e9" * n)
    media = matroska.mux(payload)
    parts = list(plain_walk(media, 0, len(media), {"18538067", "1f43b675", "1654ae6b", "ae", "e1", "1c53bb6b", "bb", "b7"}))
    held = b""
    for ident, body in parts:
        if ident == "a3":
            assert body[0] == 0x81
            scheme, rest = body[3] >> 1 & 3, body[4:]
            if scheme:
                n_frames, rest = rest[0] + 1, rest[1:]
                if scheme == 1:
                    for _ in range(n_frames - 1):
                        while rest[0] == 255:
                            rest = rest[1:]
                        rest = rest[1:]
                elif scheme == 3:
                    for _ in range(n_frames - 1):
                        rest = rest[9 - rest[0].bit_length() :]
            held += rest
    assert held == payload
    assert dict(parts)["86"] == b"A_PCM/INT/LIT" and np.frombuffer(dict(parts)["b5"], ">f4")[0] == 8000


def box(ident, body):
    return bytes.fromhex(ident) + bytes([0x08, *len(body).to_bytes(4, "big")]) + body


def test_timestamps_follow_the_track():
    track = lambda number, *more: box("ae", box("d7", bytes([number])) + b"".join(more))
    tracks = box("1654ae6b", track(1, box("23e383", (20_000_000).to_bytes(4, "big"))) + track(2, box("86", b"A_PCM/INT/LIT"), box("e1", box("b5", np.array(1000, ">f8").tobytes()) + box("9f", b"\2") + box("6264", b"\x10"))) + track(3))
    block = lambda number, at: bytes([0x80 | number]) + at.to_bytes(2, "big", signed=True) + bytes([2 << 1, 1]) + b"x" * 8  # noqa: E731  two frames of four bytes
    cluster = box("1f43b675", box("e7", b"\x64") + box("a3", block(1, 0)) + box("a0", box("a1", block(2, -10))) + box("a3", block(3, 4)))
    media = box("1a45dfa3", b"") + box("18538067", box("1549a966", box("2ad7b1", (500_000).to_bytes(3, "big"))) + tracks + cluster)
    assert [(p[0], p[1]) for p in matroska.demux(media)[0]] == [(1, 50), (1, 70), (2, 45), (2, 46), (3, 52), (3, 52)]


def test_malformed_media_are_rows(spark):
    good = matroska.mux(matroska.payload_of("hello"))
    rows = [(1, good), (2, good[:-3]), (3, b"\0\0\0"), (4, b"\xff" * 50), (5, None), (6, b""), (7, bytes.fromhex("18538067ff") * 3000), (None, good), (1, good)]
    got = matroska.packet_table(spark.createDataFrame([(k, m, "e", 1) for k, m in rows], "doc_id long, media binary, error string, track int")).collect()
    assert {r.doc_id for r in got if r.error} == {2, 3, 4, 7}
    assert sorted(str(r.doc_id) for r in got if r.error is None) == ["1", "1", "None"]
    assert matroska.media_columns(frame(spark, [])).count() == 0 and matroska.packet_table(spark.createDataFrame([], "doc_id long, media binary")).count() == 0


def test_empty_tables_give_no_rows(spark):
    model = queries.tokenizer("piece_bpe_32k.model")
    assert piece_sampling.encode(frame(spark, []), model).count() == 0
    assert quality_rules.keep(frame(spark, [])).count() == 0

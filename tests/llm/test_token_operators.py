"""Search, token counts, shards, chat windows and page text against brute force and round trips."""

import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from churnloom.llm import chat, html, order, registry, tokens, topk
from churnloom.llm.store import stored
from llm.helpers import DATA, ODD_TEXTS, digest, empty_documents, odd_documents

SMALL = f"{DATA}/sf0.001"


def brute_top(rows, k=5):
    out = set()
    asked = {}
    for name, v in rows:
        if name % 50 == 0:
            asked[name] = min(v, asked.get(name, v))
    for q, v in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), name) for name, w in rows if name != q and len(w) == len(v))
        out |= {(q, rank, name, -s) for rank, (s, name) in enumerate(scores[:k], 1)}
    return out


@pytest.mark.parametrize(("chunk", "block"), [(4096, 1024), (40, 3)])
def test_top_k_equals_brute_force(spark, monkeypatch, chunk, block):
    monkeypatch.setattr(topk, "CHUNK", chunk)
    monkeypatch.setattr(topk, "BLOCK", block)
    rows = [(r.vec_id, [int(np.floor(256 * x)) for x in np.array(r.embedding, float)]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = {tuple(r) for r in registry.op4_top_k(spark, SMALL).select("query_id", "rank", "vec_id", "score").collect()}
    assert got == brute_top(rows)


def test_meetings_of_one_block_are_dealt_over_the_tasks(spark, monkeypatch):
    """Forty chunks and one block of queries: no task holds them all, and each meeting takes place once."""
    monkeypatch.setattr(topk, "CHUNK", 512)
    rows = spark.range(20_480).select(F.col("id").alias("vec_id"), F.array(F.rand(1), F.rand(2)).alias("v")).withColumn("dim", F.size("v"))
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {c: spark.conf.get(c, None) for c in names}
    for c, v in zip(names, ("-1", "-1", "false"), strict=True):
        spark.conf.set(c, v)
    try:
        met = topk.meetings(rows, rows.where("vec_id < 400")).select("chunk", "block", F.spark_partition_id().alias("task")).collect()
    finally:
        for c, v in before.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)
    assert sorted((r.chunk, r.block) for r in met) == [(k, 0) for k in range(40)]
    per_task = [[r.task for r in met].count(t) for t in {r.task for r in met}]
    assert len(per_task) >= 6 and max(per_task) <= 12


def test_meetings_are_neither_broadcast_nor_put_together(spark, monkeypatch):
    """The listed rows are many times as large as the compressed ones that Spark judges by."""
    monkeypatch.setattr(topk, "CHUNK", 512)
    monkeypatch.setattr(topk, "BLOCK", 64)
    rows = spark.range(4096).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.col("id").cast("double")).alias("v")).withColumn("dim", F.size("v"))
    met = topk.meetings(rows, rows.where("vec_id < 128")).select("chunk", "block", F.spark_partition_id().alias("task"))
    met.persist()
    try:
        assert sorted((r.chunk, r.block) for r in met.collect()) == [(k, b) for k in range(8) for b in range(2)]
        assert "Broadcast" not in met._jdf.queryExecution().executedPlan().toString()
        assert met.select("task").distinct().count() > 4
    finally:
        met.unpersist()


def test_best_of_a_chunk_are_those_of_all_pairs(monkeypatch):
    """With many and with few survivors, ties, repeated ids, few rows, and products beyond 2^53 and beyond a long."""
    rng = np.random.default_rng(6)
    for sparse in (0.0, 2.0):
        monkeypatch.setattr(topk, "SPARSE", sparse)
        for trial in range(60):
            n, m, d, k = (int(rng.integers(1, most)) for most in (80, 30, 20, 8))
            x = rng.integers(-3, 4, (n, d)) * (1.0, 1e8, 1e14)[trial % 3] + 20.0 * rng.integers(-3, 4, (n, 1)) * (trial % 2)
            ids, q_ids, q = rng.integers(0, 40, n), rng.choice(60, m, replace=False), x[rng.integers(0, n, m)]
            got, want = topk.best_in_chunk(q_ids, q, ids, x, k), []
            for name, v in zip(q_ids.tolist(), q.tolist(), strict=True):
                scores = [(-sum(int(a) * int(b) for a, b in zip(v, w, strict=True)), i) for i, w in zip(ids.tolist(), x.tolist(), strict=True) if i != name]
                want += [(name, i, max(min(-s, 2**63 - 1), -(2**63))) for s, i in sorted(scores)[:k]]
            assert got == want


def test_top_k_of_odd_vectors(spark):
    rng = random.Random(2)
    rows = [(k, [rng.uniform(-2, 2) for _ in range(9)]) for k in range(60)]
    rows += [(k, [0.5] * 9) for k in range(100, 112)]  # ties
    rows += [(150, [1.0, 2.0]), (151, [2.0, 1.0]), (200, [1e12] * 3), (201, [-1e12, 1e3, 2.0])]
    bad = [(300, None), (301, []), (302, [1.0, None]), (350, [float("nan")] * 9), (303, [float("inf")] * 9), (None, [0.1] * 9)]
    df = spark.createDataFrame([(*r, "mine", 1.0) for r in rows + bad], "vec_id bigint, embedding array<double>, e string, score double")
    got = {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect()}
    whole = [(k, [int(np.floor(256 * x)) for x in v]) for k, v in rows if k < 200]
    assert {r for r in got if r[0] < 200} == brute_top(whole)
    assert (200, 1, 201) in {r[:3] for r in got}
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_bounds_never_pass_the_true_distance():
    rng = np.random.default_rng(0)
    q, x = rng.normal(size=(5, 20)), rng.normal(size=(30, 20))
    true = ((q[:, None] - x[None]) ** 2).sum(2)
    last = np.zeros_like(true)
    for parts in topk.LEVELS:
        low = topk._bounds(q, x, parts)
        assert (low <= true + 1e-9).all()
        last = low
    assert (last >= topk._bounds(q, x, 1) - 1e-9).all()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary_path())


def test_token_counts_equal_the_library(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").collect()}
    for r in registry.op6_token_counts(spark, f"{DATA}/sf0.01").collect():
        n = len(library.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 1024)


@pytest.mark.parametrize("table", [1 << 21, 20])
def test_ids_of_any_characters_equal_the_library(library, monkeypatch, table):
    monkeypatch.setattr(tokens, "TABLE", table)
    own = tokens.Tokenizer(tokens.vocabulary_path(), ids=True)
    rng = random.Random(8)
    alphabet = "ab  \t\n''''sstrevmld12.,!?é 　ß中٣\x1c\x85​"
    for _ in range(60):
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 90))) + rng.choice(["", "<|endoftext|>", "<|endoftext|> x", "it's we'll 'sx ''re"]) for _ in range(30)]
        texts += [None, "", "a" * 500, "<|endoftext|>" * 2]
        counts, ids = own(pa.array(texts))
        want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def test_state_maps_compose_over_chunks(monkeypatch):
    rng = np.random.default_rng(4)
    kinds = rng.integers(0, 7, 1000).astype(np.uint8)
    monkeypatch.setattr(tokens, "CHUNK", 1000)
    one = tokens.run_transducer(kinds)
    for chunk in (1, 3, 64):
        monkeypatch.setattr(tokens, "CHUNK", chunk)
        assert np.array_equal(one, tokens.run_transducer(kinds))


def test_tokens_of_odd_rows(spark, library):
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in tokens.token_counts(odd_documents(spark)).collect())
    assert got == sorted((str(d), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in ODD_TEXTS)
    docs = odd_documents(spark)
    assert tokens.with_tokens(docs).columns == docs.columns
    assert tokens.token_counts(empty_documents(spark)).count() == 0


def test_feistel_takes_every_slot_once(spark):
    for n in (1, 2, 5, 100, 4096, 4099):
        got = [r.s for r in spark.range(n).select(order.feistel(F.col("id"), F.lit(n).cast("bigint")).alias("s")).collect()]
        assert sorted(got) == list(range(n))


def read_records(spark, path, length, shard):
    """Records as a reader seeks them: slot -> ids."""
    out = {}
    for f in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("path LIKE '%.txt'").collect():
        number = int(f.path.split("shard=")[1].split("/")[0])
        stride = 2 * length + 1
        assert f.length % stride == 0
        for k in range(f.length // stride):
            assert number * shard + k not in out
            record = bytes(f.content)[k * stride : (k + 1) * stride]
            assert record[-1:] == b"\n"
            out[number * shard + k] = struct.unpack(f"<{length}H", record[:-1])
    return out


@pytest.mark.parametrize("parts", [1, 3])
def test_shards_hold_every_token_in_slot_order(spark, library, tmp_path, parts):
    docs = stored(spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).unionByName(odd_documents(spark, False).where("doc_id IS NULL OR doc_id <> 7")).repartition(parts, "lang", "doc_id"), "some")
    path = str(tmp_path / "shards")
    rows = order.materialise(docs, path, length=128, shard=16).collect()
    records = read_records(spark, path, 128, 16)
    assert sorted(records) == list(range(len(rows))) == sorted(r.slot for r in rows)
    for r in rows:
        assert r.record_sha256 == __import__("hashlib").sha256(struct.pack("<128H", *records[r.slot])).hexdigest()
        assert (r.shard, r.offset) == (r.slot // 16, r.slot % 16 * 257)
        assert len(r.doc_ids) == len(r.doc_at) > 0
    end = library.token_to_id("<|endoftext|>")
    stream = [i for r in sorted(rows, key=lambda r: r.seq) for i in records[r.slot][: r.n_tokens]]
    got, text = [], []
    for i in stream:
        if i == end:
            got.append(tuple(text))
            text = []
        else:
            text.append(i)
    want = [tuple(library.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()]
    assert sorted(got) == sorted(want) and not text
    names = {str(d) for r in rows for d in r.doc_ids}
    assert names == {str(r.doc_id) for r in docs.collect()}


def test_no_documents_make_no_shards(spark):
    assert order.materialise(empty_documents(spark), length=16, shard=4).count() == 0


def brute_chat(rows):
    conv = {}
    for r in rows:
        conv.setdefault(r[0], []).append((r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    out = {}
    for c, turns in conv.items():
        turns.sort()
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out[c] = (len(turns), digest("".join(f"{t[2]}\n{t[3]}\n" for t in turns)), len(loss), digest(loss))
    return out


def test_chat_digests_equal_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in registry.op8_chat_windows(spark, SMALL).collect()}
    assert got == brute_chat(rows + registry.TRAP)


def odd_turns():
    rows = [(1, 0, "system", "be <brief> [INST] \\0 \\1"), (1, 1, "user", None), (1, 2, "assistant", "</s><s>assistant\nno\\2"), (1, 3, None, "x"), (2, None, "assistant", ""), (2, 0, "assistant", "a\nb")]
    rows += [(3, k, ["user", "assistant"][k % 2], f"turn {k} " + "word " * (k % 90)) for k in range(400)]
    rows += [(3, 7, "assistant", "again"), (None, 0, "user", "who"), (4, 5, "assi\nstant", "🙂 \\"), (5, 0, "system", "s"), (5, 1, "assistant", "long " * 30000), (5, 2, "assistant", "end")]
    return rows


@pytest.mark.parametrize(("budget", "history"), [(512, 2), (40, 0), (10, 5)])
def test_chat_windows_of_odd_turns(spark, budget, history):
    rows = odd_turns()
    df = spark.createDataFrame([(*r, 1, "mine") for r in rows], "conv_id bigint, turn bigint, role string, text string, span int, size string")
    windows = chat.format_windows(df, budget=budget, history=history).collect()
    back = chat.read_windows(chat.format_windows(df, budget=budget, history=history)).collect()
    want = brute_chat(rows)
    assert {r.conv_id: (r.n_turns, digest(r.turns), len(r.loss), digest(r.loss)) for r in back} == want
    for w in windows:
        assert w.formatted.count("<s>") == w.formatted.count("</s>") == w.turns
        if w.conv_id == 1 and w.span > 0:
            assert w.formatted.startswith("<s>system\n")
        assert w.repeated <= history + 1
        for s in w.loss:
            assert w.formatted[: s.begin].endswith("<s>assistant\n") and w.formatted[s.begin + s.length :].startswith("</s>")
    assert chat.format_windows(df.limit(0)).count() == 0


PAGES = [
    (None, ""),
    ("", ""),
    ("just words", "just words"),
    ("<p>a &amp; b&nbsp;c<br>d\n e</p><p>f", "a & b c d e\n\nf"),
    ("<article><h1>T</h1><p>one <b>two</b><p>three</article><footer>&copy; x</footer>", "T\n\none two\n\nthree"),
    ('<script>var t="</p>";</script><style>p{}</style><nav><a href="/">home</a></nav><article><p>x &lt;y&gt;</p></article>', "x <y>"),
    ('<main><p>Body.</p><form>name <input></form><div class="cookie-notice">ok?</div><aside>more</aside></main>', "Body."),
    ('<article><p>Text.</p><section id="comments"><p>first!</p></section></article><div class="ad">buy</div>', "Text."),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", "one\n\ntwo\n\na\n\nb"),
    ('<article><p title="a > b">quoted</p><p title="open>still</p></article>', "quoted\n\nstill"),
    ("<article>1 < 2 and <!-- <p>no</p> --> 3</article>", "1 < 2 and 3"),
    ("<article><p>caf&eacute; &#8364; &#x41; &unknown;</p>", "café € A &unknown;"),
    (
        "<body><div class='top'><a href=1>Home</a></div><div class='story'><p>A long sentence, with commas, and more of it. Then another one, longer still.</p>"
        "<p>The second paragraph goes on, and on, until it ends.</p></div><div class='links'><ul><li><a href=2>x</a></li><li><a href=3>y</a></li></ul></div></body>",
        "A long sentence, with commas, and more of it. Then another one, longer still.\n\nThe second paragraph goes on, and on, until it ends.",
    ),
]


@pytest.mark.parametrize(("page", "want"), PAGES)
def test_main_text(page, want):
    assert html.main_text(page) == want


def test_pages_keep_their_columns(spark):
    df = spark.createDataFrame([(k, "u", p, "mine") for k, (p, _) in enumerate(PAGES)] + [(99, None, "<article><p>" + "word " * 400_000, None)], "page_id bigint, url string, html string, n_chars string")
    out = html.extract(df)
    assert out.columns == ["page_id", "url", "n_chars", "text"]
    got = {r.page_id: r.text for r in out.collect()}
    assert {k: got[k] for k in range(len(PAGES))} == {k: w for k, (_, w) in enumerate(PAGES)}
    assert len(got[99]) == 400_000 * 5 - 1
    assert html.extract(df.limit(0)).count() == 0


def test_main_text_of_the_pages_is_their_article(spark):
    import re
    from html import unescape

    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        inner = r.html.split("<article>")[1].split("</article>")[0]
        parts = [re.sub(r"\s+", " ", unescape(re.sub(r"</?b>", "", x).replace("<br>", " "))).strip() for x in re.split(r"</?(?:p|h1)>", inner)]
        assert html.main_text(r.html) == "\n\n".join(p for p in parts if p)


def test_ratios_find_the_text_without_the_article_tags(spark):
    import re

    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        assert html.main_text(re.sub("</?article>", "", r.html)) == html.main_text(r.html)


def test_marks_and_class_words_only_weigh():
    long = "A long sentence, with commas, and more of it. Then another one, longer still. " * 3
    story = f"<p>{long}</p><p>{long}</p>"
    text = f"{long.strip()}\n\n{long.strip()}"
    # an article that is a teaser card, and the text in a div
    assert html.main_text(f"<body><article><p>Read more here</p></article><div class='story'>{story}</div></body>") == text
    # all the text of the page stands in an element with such a word
    assert text in html.main_text(f"<body><div class='social-story'>{story}</div><div><p>About us</p></div></body>")
    assert html.main_text(f"<body><div>{story}</div><div class='comments'>{story}</div></body>") == text


LONG = "A long sentence, with commas, and more of it. Then another one, longer still. " * 3
SHAPES = [
    ("<ul><li>short one</li><li>two</li></ul>", ["short one", "two"]),
    ("<table><tr><td>a</td><td>b</td></tr></table>", ["a", "b"]),
    ("<dl><dt>term</dt><dd>meaning</dd></dl>", ["term", "meaning"]),
    ("<header><h1>Title</h1></header>", ["Title"]),
    ("<blockquote>said so</blockquote>", ["said so"]),
    ("<pre>code</pre>", ["code"]),
    ("<figure><figcaption>a caption</figcaption></figure>", ["a caption"]),
    ("<div><p>boxed</p></div>", ["boxed"]),
    ("<section><p>part</p></section>", ["part"]),
    ("<h2>Heading</h2>", ["Heading"]),
]


@pytest.mark.parametrize(("shape", "want"), SHAPES)
@pytest.mark.parametrize("around", ["<article>{}</article>", "<main>{}</main>", "<div class='story'>{}</div>"])
def test_no_block_of_the_article_is_lost_for_being_short(shape, want, around):
    if "<header>" in shape and "article" not in around:
        return
    page = "<body><nav><a href=1>Home</a></nav>" + around + "<div><ul><li><a href=2>About us</a></li></ul></div><footer>imprint</footer></body>"
    p, long = f"<p>{LONG}</p>", LONG.strip()
    assert html.main_text(page.format(shape + p + p)) == "\n\n".join([*want, long, long])
    assert html.main_text(page.format(p + shape + p)) == "\n\n".join([long, *want, long])
    assert html.main_text(page.format(p + p + shape)) == "\n\n".join([long, long, *want])


@pytest.mark.parametrize("name", ["social-network-history", "sponsored-post"])
def test_an_article_is_not_lost_for_its_own_class(name):
    page = f"<body><div class='teaser'><p>Read this, and that, and more of it.</p></div><article class='{name}'><h1>T</h1><p>{LONG}</p></article></body>"
    assert html.main_text(page) == f"T\n\n{LONG.strip()}"
    with_reply = f"<body><article><p>{LONG}</p></article><article class='comment'><p>First! So good, so true, thank you all.</p></article></body>"
    assert html.main_text(with_reply) == LONG.strip()

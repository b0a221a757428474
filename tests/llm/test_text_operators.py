"""Decontamination, near-duplicates, quality, mixing and line dedup against brute force."""

import os
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from churnloom.llm import decontaminate, lines, minhash, mixing, quality, registry
from churnloom.llm.text import NOT_LETTERS, SPACES, WordHasher
from churnloom.session import shared_dir
from llm.helpers import DATA, LETTERS, ODD_TEXTS, SPACED, contamination, digest, empty_documents, lower, near_components, odd_documents, targets

SMALL = f"{DATA}/sf0.001"
ITEMS = "item_id bigint, text string"


def rows_of(spark, name, *columns, sf=SMALL):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/{name}.parquet").select(*columns).collect()]


@pytest.mark.parametrize(("gap", "pattern"), [(NOT_LETTERS, LETTERS), (SPACES, SPACED)])
def test_words_are_cut_as_the_patterns_say(gap, pattern, monkeypatch):
    monkeypatch.setattr("churnloom.llm.text.PIECE", 64)
    texts = [t for _, t in ODD_TEXTS if len(t or "") < 1000] + ["", None, "ab", "cd ", "é" * 200 + " x"]
    hashes, counts = WordHasher(gap)(pa.array(texts))
    want = [pattern.findall(lower(t)) for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    by_word = defaultdict(set)
    for h, w in zip(hashes.tolist(), (w for ws in want for w in ws), strict=True):
        by_word[w].add(h)
    assert all(len(h) == 1 for h in by_word.values())
    assert len({h for hs in by_word.values() for h in hs}) == len(by_word)


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    for alphabet in (1, 2, 50):
        keys = rng.integers(0, alphabet, 300).astype(np.uint64)
        order = decontaminate.suffix_array(keys, 8)
        assert sorted(order.tolist()) == list(range(300))
        heads = [tuple(keys[k : k + 8].tolist()) for k in order]
        assert heads == sorted(heads)


def test_decontamination_equals_brute_force(spark):
    got = {r.doc_id: r for r in registry.op1_decontaminate(spark, SMALL).collect()}
    want = contamination(rows_of(spark, "documents", "doc_id", "text"), rows_of(spark, "benchmark", "item_id", "text"))
    assert len(got) == len(want) and any(hit for _, _, hit, _ in want)
    for name, n, hit, items in want:
        r = got[name]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, len(hit), len(items), bool(hit))
        assert r.items_sha256 == digest(",".join(sorted(map(str, items))))


def test_decontamination_of_odd_rows_over_many_blocks_and_shards(spark, monkeypatch):
    items = [(1, "one"), (2, None), (3, ""), (4, "b c d e f g h i j k l"), (5, "B, C, D; e f g h i j k l!"), (None, "no id here at all"), (12, "lorem ipsum " * 8)]
    bench = spark.createDataFrame(items, ITEMS)
    docs = odd_documents(spark)
    want = contamination(ODD_TEXTS, items)
    for block in (40, 1 << 20):
        found = decontaminate.find_matches(docs, bench, block_bytes=block)
        assert set(found.columns) == {*docs.columns, "n_words", "items", "matches", "hit_words"}
        got = sorted((str(r.doc_id), r.n_words, tuple(r.hit_words), tuple(sorted(r["items"]))) for r in found.collect())
        assert got == sorted((str(d), n, tuple(hit), tuple(sorted(i))) for d, n, hit, i in want)
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(str(d) for d, _, hit, _ in want if not hit)
    assert decontaminate.find_matches(empty_documents(spark), bench).count() == 0
    assert decontaminate.find_matches(docs, bench.limit(0)).where("size(hit_words) > 0").count() == 0


def test_matches_are_longest_and_a_long_document_is_cut_without_loss(monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD", 128)
    rng = random.Random(5)
    words = [rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(700)]
    item = words[55:80] + ["never"] + words[300:311]
    block = decontaminate.make_block([([1], " ".join(item))], 10)
    hashes, counts = WordHasher(NOT_LETTERS)(pa.array([" ".join(words), "a b"]))
    hits, seen, records = decontaminate._mark(hashes, counts, block, 10, True)
    want = contamination([(0, " ".join(words))], [(1, " ".join(item))])[0][2]
    assert hits[hits[:, 0] == 0, 1].tolist() == want
    assert {(at, n) for _, _, at, n in records.tolist()} >= {(55, 25), (300, 11)}


def brute_matches(words, item, window):
    """(item place, document place, length) of matches that do not continue one from the word before."""
    out = set()
    for k in range(len(item)):
        for at in range(len(words)):
            if k and at and item[k - 1] == words[at - 1]:
                continue
            n = 0
            while k + n < len(item) and at + n < len(words) and item[k + n] == words[at + n]:
                n += 1
            if n >= window:
                out.add((k, at, n))
    return out


def test_matches_longer_than_the_search_and_the_shard(monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD", 128)
    monkeypatch.setattr(decontaminate, "DEPTH", 16)
    monkeypatch.setattr(decontaminate, "TOGETHER", 50)
    rng = random.Random(6)
    words = [rng.choice("abc") * rng.randint(1, 2) for _ in range(400)]
    item = words[20:320] + ["never"] + words[100:140]
    block = decontaminate.make_block([([1], " ".join(item))], 10)
    hashes, counts = WordHasher(NOT_LETTERS)(pa.array([" ".join(words)]))
    hits, _, records = decontaminate._mark(hashes, counts, block, 10, True)
    assert {(int(block.place[k]), at, n) for _, k, at, n in records.tolist()} == brute_matches(words, item, 10)
    assert hits[:, 1].tolist() == list(range(20, 320))


def test_an_item_longer_than_a_shard(spark):
    rng = np.random.default_rng(8)
    item = " ".join(f"w{k}" for k in rng.integers(0, 10**6, 600_000).tolist())
    middle = " ".join(item.split(" ")[300_000:300_030])
    bench = spark.createDataFrame([(1, item), (2, item), (3, "a b c")], ITEMS)
    docs = spark.createDataFrame([(1, f"before {middle} after"), (2, "nothing here")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in decontaminate.find_matches(docs, bench).collect()}
    assert list(got[1].hit_words) == list(range(1, 31)) and sorted(got[1]["items"]) == [1, 2]
    assert {(m.item_id, m.item_pos, m.doc_pos, m.length) for m in got[1].matches} == {(1, 300_000, 1, 30), (2, 300_000, 1, 30)}
    assert not got[2].hit_words


def test_equal_items_cost_one(spark):
    bench = spark.createDataFrame([(k, "spam " * 20_000) for k in range(200)], ITEMS)
    rows = [r for r in decontaminate._blocks(bench, 1 << 24)]
    assert [(len(ids), len(text)) for ids, text in rows[0]] == [(200, 100_000)] and len(rows) == 1
    block = decontaminate.make_block(rows[0], 10)
    hashes, counts = WordHasher(NOT_LETTERS)(pa.array(["spam " * 20_000]))
    start = time.perf_counter()
    hits, seen, records = decontaminate._mark(hashes, counts, block, 10, False)
    assert time.perf_counter() - start < 1
    assert len(hits) == 20_000 and len(seen) == 1 and not len(records)


def test_near_duplicates_equal_brute_force(spark):
    got = {r.doc_id: r for r in registry.op2_near_duplicates(spark, SMALL).collect()}
    want = near_components(rows_of(spark, "documents", "doc_id", "text"))
    assert len(got) == len(want) and any(d != c for d, (_, c) in want.items())
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == want
    assert all(r.kept == (d == r.component_id) for d, r in got.items())


@pytest.fixture(scope="module")
def chained():
    """Near copies, each made from another one, and unrelated texts that share a passage."""
    rng = random.Random(11)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    chain = [fresh(150)]
    while len(chain) < 260:
        copy = list(rng.choice(chain))
        copy[rng.randrange(150)] = fresh(1)[0]
        chain.append(copy)
    passage = fresh(45)
    shared = [fresh(rng.randint(5, 60)) + passage + fresh(rng.randint(5, 60)) for _ in range(120)]
    return [(3 * k + 1, " ".join(w)) for k, w in enumerate(chain + shared + chain[:9])]


def test_chains_of_near_copies_over_many_blocks(spark, chained, monkeypatch):
    want = near_components(chained)
    docs = spark.createDataFrame(chained, "doc_id bigint, text string")
    for members in (2048, 50):
        monkeypatch.setattr(minhash, "BLOCK_MEMBERS", members)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()}
        assert got == want
    kept = minhash.drop_near_duplicates(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, (_, c) in want.items() if d == c)


def test_the_stage_drops_copies_from_four_fifths_on(spark):
    rng = random.Random(7)
    rows, want = [], {80: set(), 85: set()}
    for k, shingles in enumerate(range(36, 66)):
        words = [f"w{rng.randrange(10**9)}" for _ in range(shingles + 4)]
        copy = words[:20] + ["other"] + words[21:]
        rows += [(2 * k, " ".join(words), "en", "s", 0), (2 * k + 1, " ".join(copy), "en", "s", 0)]
        for least, gone in want.items():
            if 100 * (shingles - 5) >= least * (shingles + 5):
                gone.add(2 * k + 1)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert len(want[80] - want[85]) > 10
    kept = {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, SMALL).collect()}
    assert {d for d, *_ in rows} - kept == want[80]
    assert {r.doc_id for r in minhash.near_duplicates(docs).collect() if not r.kept} == want[85]


def test_components_of_any_links(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(1000, 1040)]
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = {r.doc_id: r.component_id for r in minhash.components(spark.createDataFrame(edges, "low bigint, high bigint")).collect()}
    assert {**got, **{c: c for c in got.values()}} == label


def test_near_duplicates_of_odd_rows(spark):
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in minhash.near_duplicates(odd_documents(spark)).collect())
    assert [r for r in got if r[0] in ("5", "6")] == [("5", 12, "5", True), ("6", 12, "5", False)]
    assert ("1", 0, "1", True) in got and ("None", 1, "None", True) in got and len(got) == len(ODD_TEXTS) - 1
    kept = minhash.drop_near_duplicates(odd_documents(spark))
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(str(d) for d, _ in ODD_TEXTS if d != 6)
    assert minhash.near_duplicates(empty_documents(spark)).count() == 0


def test_quality_tells_held_out_labels(spark):
    sf = f"{DATA}/sf0.1"
    scored = registry.op3_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").select("score", "predicted", "quality").toPandas()
    order = scored["score"].rank()
    good = scored["quality"] == 1
    area = (order[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert area > 0.97
    assert (scored["predicted"] == scored["quality"]).mean() > 0.95
    assert (scored["predicted"] == (scored["score"] >= 0.7)).all()


def test_quality_of_odd_rows_and_labels(spark):
    labels = spark.createDataFrame([(5, 1), (5, 1), (9, 0), (None, 1), (3, None), (77, 1)], "doc_id bigint, quality int")
    docs = odd_documents(spark)
    weights = quality.fit(docs.select("doc_id", "text"), labels)
    assert np.isfinite(weights).all() and weights.any()
    got = quality.score(docs, weights).select("doc_id", "score").collect()
    assert len(got) == len(ODD_TEXTS) and all(0 <= r.score <= 1 for r in got)
    assert quality.keep_good(docs, labels, threshold=0.0).columns == docs.columns
    one_class = labels.where("quality = 1")
    assert {r.score for r in quality.score(docs, quality.fit(docs.select("doc_id", "text"), one_class)).select("score").collect()} == {0.5}
    assert quality.keep_good(empty_documents(spark), labels).count() == 0


def test_a_document_is_scored_by_its_text_alone(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    weights = quality.fit(docs, registry.labelled_for_training(spark, SMALL))
    again = quality.fit(docs.repartition(5), registry.labelled_for_training(spark, SMALL).repartition(3))
    assert np.array_equal(weights, again)


def test_quality_sample_holds_a_rare_class(spark):
    rows = [(k, f"good words that read well {k}" if k % 50 == 0 else f"bad junk spam noise {k}") for k in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    # labels of documents that are not there come first and take no place
    labels = spark.createDataFrame([(k, int(k % 50 == 0)) for k in range(1000)] + [(k, 0) for k in range(5000, 9000)], "doc_id bigint, quality int")
    weights = quality.fit(docs, labels, sample=20)
    got = {r.doc_id: r.score for r in quality.score(docs, weights).collect()}
    assert weights.any() and min(got[k] for k in range(0, 1000, 50)) > max(s for k, s in got.items() if k % 50)
    # rows that repeat an id are learnt once
    assert np.array_equal(weights, quality.fit(docs.union(docs).union(docs), labels, sample=20))
    assert quality.shares({0.0: 10**6, 1.0: 1000}, 20_000) == {0.0: 19_000, 1.0: 1000}
    assert quality.shares({0.0: 10**6, 1.0: 10**4}, 20_000) == {0.0: 18_000, 1.0: 2000}
    with pytest.warns(UserWarning):
        assert quality.keep_good(docs, labels.where("quality = 0")).count() == 1000


def check_mix(rows, got):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(SPACED.findall(text or ""))
    goal = targets(sizes)
    taken = Counter()
    assert len(got) == len(rows)
    for r, source in got:
        assert r.source_size == sizes[source]
        assert r.target == pytest.approx(goal[source])
        assert 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    for source, want in goal.items():
        assert want - 1 <= taken[source] <= want


def test_mixing_meets_its_targets(spark):
    rows = rows_of(spark, "documents", "doc_id", "text", "source", sf=f"{DATA}/sf0.01")
    source = {d: s for d, _, s in rows}
    first = registry.op5_mixing(spark, f"{DATA}/sf0.01").collect()
    check_mix(rows, [(r, source[r.doc_id]) for r in first])
    again = registry.op5_mixing(spark, f"{DATA}/sf0.01").collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_mixing_of_odd_rows(spark):
    docs = odd_documents(spark)
    source = {d: None if d == 3 else f"s{(d or 0) % 3}" for d, _ in ODD_TEXTS}
    check_mix([(d, t, source[d]) for d, t in ODD_TEXTS], [(r, source[r.doc_id]) for r in mixing.taken_words(docs).collect()])
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    taken = Counter()
    for r in mixing.taken_words(docs).collect():
        taken[r.doc_id] += r.taken
    words = Counter()
    for r in mixed.select("doc_id", "text").collect():
        words[r.doc_id] += len(SPACED.findall(r.text))
    assert {d: n for d, n in taken.items() if n} == dict(words)
    assert mixing.taken_words(empty_documents(spark)).count() == 0
    assert mixing.mix(empty_documents(spark)).count() == 0


def test_permutations_take_every_number_once(spark):
    for n in (1, 2, 3, 7, 64, 1000, 4097):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(5).cast("bigint")).alias("p"))
        got = [r.p for r in df.collect()]
        assert sorted(got) == list(range(n))
        assert n < 64 or sum(a == b for a, b in enumerate(got)) < n / 4


def test_parts_of_a_document_give_its_text(spark):
    docs = spark.createDataFrame([(1, " a  b\tc \n" + "word " * 700 + "end", "x", 0), (2, "z " * 5000, "y", 0)], "doc_id bigint, text string, source string, n_chars bigint")
    mixed = mixing.mix(docs).collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text in text[r.doc_id] and r.n_chars == len(r.text) for r in mixed)


def test_shards_of_fixed_size_draw_their_sources_by_weight(spark):
    sizes = mixing.sized(spark.read.parquet(f"{DATA}/sf0.01/documents.parquet"))
    goals = mixing.targets(sizes)
    per = {r.source: r for r in goals.collect()}
    rows = sorted(mixing.slots(goals, 32, 64).collect(), key=lambda r: (r.shard, r.slot))
    assert [(r.shard, r.slot) for r in rows] == [(k // 64, k % 64) for k in range(len(rows))]
    by_source = defaultdict(list)
    for r in rows:
        by_source[r.source].append(r)
    whole, spread = rows[: len(rows) // 64 * 64], 0
    for source, own in by_source.items():
        assert sum(r.words for r in own) == int(per[source].target) and min(r.words for r in own) > 0
        # in the order of the mix the source is read through before it repeats
        assert [r.turn for r in own] == list(range(len(own)))
        blocks = -(-per[source].source_size // 32)
        assert all(len({r.block for r in own[k : k + blocks]}) == len(own[k : k + blocks]) for k in range(0, len(own), blocks))
        share = len(own) / len(rows)
        assert abs(share - per[source].target / sum(p.target for p in per.values())) < 0.01
        counts = Counter(r.shard for r in whole if r.source == source)
        off = [(counts[k] - 64 * share) / (64 * share * (1 - share)) ** 0.5 for k in range(len(whole) // 64)]
        assert max(map(abs, off)) < 6
        spread += np.mean(np.square(off)) / len(by_source)
    # drawn, neither dealt in turn nor in clumps
    assert len(whole) > 64 * 50 and 0.8 < spread < 1.2


def test_the_mix_comes_in_the_order_of_its_shards(spark):
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(600)), f"s{k % 2}", 0) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint")
    got = mixing.mixed(docs, shard_slots=16).collect()
    at = [(r.shard, r.slot) for r in got]
    assert at == sorted(at) and len(set(at)) > 140 and max(s for _, s in at) == 15
    assert [tuple(r) for r in mixing.mix(docs, shard_slots=16).collect()] == [tuple(r)[:4] for r in got]
    names = [n for k, n in enumerate(r.doc_id for r in got) if not k or at[k] != at[k - 1]]
    assert sum(a == b for a, b in zip(names[:-1], names[1:], strict=True)) < len(names) / 8
    taken = Counter()
    for r in got:
        taken[r.doc_id] += len(r.text.split())
    assert {r.doc_id: r.taken for r in mixing.taken_words(docs).collect() if r.taken} == dict(taken)


def drain(docs, min_docs=5):
    """Line dedup, leaf by leaf, over plain Python."""
    leaves = defaultdict(set)
    for _, text in docs:
        for line in (text or "").split("\n"):
            w = masked(line)
            if len(w) >= lines.MIN_WORDS:
                leaves[len(w), tuple(w[: lines.DEPTH])].add(" ".join(w))
    return leaves


def masked(line):
    import re

    return re.sub(r"[^ ]*[0-9][^ ]*", lines.ANY, re.sub(r"[ \t\n\x0b\f\r]+", " ", line)).strip(" ").split(" ")


def test_recurring_templates_go(spark):
    rows = [(k, f"unique line number word{chr(97 + k)} of this text\nuser {k} logged in from host {k * 7}\nshort\n\nleft alone only here {k % 2}") for k in range(6)]
    rows += [(50, "user bob logged in from host home"), (51, None), (52, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in lines.drop_recurring_lines(docs).collect()}
    # the first line differs in one word of seven, so it is a template as well
    assert got[0].text == "short\n" and got[0].n_lines == 5 and got[0].n_dropped == 3
    assert got[51].text is None and got[52].text == "" and len(got) == len(rows)


def test_line_dedup_of_exact_repeats_and_odd_rows(spark):
    docs = rows_of(spark, "documents", "doc_id", "text")
    often = Counter()
    for _, text in docs:
        often.update({" ".join(masked(x)) for x in text.split("\n")})
    got = {r.doc_id: r for r in lines.drop_recurring_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    leaves = drain(docs)
    for name, text in docs:
        kept = got[name].text.split("\n") if got[name].text or not got[name].n_dropped else []
        for line in text.split("\n"):
            w = masked(line)
            known = len(w) >= lines.MIN_WORDS
            if known and often[" ".join(w)] >= lines.MIN_DOCS:
                assert line not in kept
            elif not known or len(leaves[len(w), tuple(w[: lines.DEPTH])]) == 1:
                assert line in kept
    odd = lines.drop_recurring_lines(odd_documents(spark))
    assert odd.count() == len(ODD_TEXTS) and odd.where("n_dropped > 0").count() == 0
    assert lines.drop_recurring_lines(empty_documents(spark)).count() == 0


def test_stages_keep_the_columns_and_bear_odd_rows(spark):
    docs = odd_documents(spark, False)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        assert stage(spark, empty_documents(spark), SMALL).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() > 0


def test_pipeline_decisions_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    scores = {r.doc_id: r.score for r in registry.op3_quality(spark, SMALL).collect()}
    one = corpus_pipeline.quality_stage(spark, docs, SMALL).collect()
    assert {r.doc_id for r in one} == {d for d, s in scores.items() if s >= quality.KEEP_FROM}
    left = [(r.doc_id, r.text) for r in one]
    kept = {d for d, (_, c) in near_components(left, minhash.STAGE_SIMILARITY).items() if d == c}
    good = docs.where(F.col("doc_id").isin([d for d, _ in left]))
    two = corpus_pipeline.near_duplicate_stage(spark, good, SMALL)
    assert sorted(r.doc_id for r in two.collect()) == sorted(kept)
    dirty = {d for d, _, hit, _ in contamination(left, rows_of(spark, "benchmark", "item_id", "text")) if hit}
    three = corpus_pipeline.decontamination_stage(spark, two, SMALL)
    assert sorted(r.doc_id for r in three.collect()) == sorted(kept - dirty)
    # every document of the mix reaches the shards
    taken = {r.doc_id for r in corpus_pipeline.mixing_stage(spark, three, SMALL).collect()}
    folder = shared_dir(spark)
    before = set(os.listdir(folder))
    last = corpus_pipeline.run(spark, SMALL).collect()
    assert {d for r in last for d in r.doc_ids} == taken <= kept - dirty
    # what the first four stages stored is gone, their results too
    left_over = {name.split("-")[0] for name in set(os.listdir(folder)) - before}
    assert left_over <= {"stage4", "shards", "sequences"}
    assert sorted(r.slot for r in last) == list(range(len(last)))


def test_sparse_ids_spread_over_the_buckets_of_a_mix(spark):
    """Hashed ids of one source: bounded numbers of buckets and of rows in each, and starts in the order of the ids."""
    docs = spark.range(20_000).selectExpr("xxhash64(id) AS doc_id", "'a' AS source", "repeat('w ', CAST(id % 7 AS INT)) AS text")
    sizes = mixing.sized(docs.unionByName(docs.limit(0)))
    held = [r["count"] for r in mixing.bucketed(sizes).groupBy("bucket").count().collect()]
    assert len(held) <= mixing.BUCKETS and max(held) <= 3 * 20_000 / mixing.BUCKETS
    rows = sorted(mixing.offsets(sizes).collect(), key=lambda r: r.doc_id)
    at = 0
    for r in rows:
        assert r.start == at
        at += r["size"]


def test_rows_without_ids_are_mixed(spark):
    docs = spark.createDataFrame([(None, "a", f"x{k} y") for k in range(30)] + [(k, "a", "z") for k in range(5)], "doc_id bigint, source string, text string")
    starts = sorted((r.start, r["size"]) for r in mixing.offsets(mixing.sized(docs)).collect())
    assert [s for s, _ in starts] == [sum(n for _, n in starts[:k]) for k in range(35)]
    none = docs.where("text IS NULL")
    assert mixing.taken_words(none).count() == 0
    assert sum(r.taken for r in mixing.taken_words(docs).collect()) == 97  # 65 words, 150 percent of them


def plain_tree(spark, docs):
    """Recurring (doc_id, line hash) by a tree over words, one line after the other."""
    spellings = {" ".join(w) for _, text in docs for x in (text or "").split("\n") if len(w := masked(x)) >= lines.MIN_WORDS}
    hashed = {r.masked: r.line for r in spark.createDataFrame([(x,) for x in spellings], "masked string").selectExpr("masked", "xxhash64(masked) AS line").collect()}
    leaves, template = defaultdict(list), {}
    for spelling in sorted(spellings, key=hashed.get):
        w = spelling.split(" ")
        own = leaves[len(w), tuple(w[: lines.DEPTH])]
        same = [sum(a == b for a, b in zip(t, w, strict=True)) for t in own]
        best = same.index(max(same)) if same else None
        if best is None or same[best] < lines.SIMILAR * len(w):
            own.append(w)
            best = len(own) - 1
        else:
            own[best] = [a if a == b else lines.ANY for a, b in zip(own[best], w, strict=True)]
        template[spelling] = (len(w), *w[: lines.DEPTH], best)
    has, stands = defaultdict(set), defaultdict(set)
    for name, text in docs:
        for x in (text or "").split("\n"):
            if (t := template.get(" ".join(masked(x)))) is not None:
                has[name].add((hashed[" ".join(masked(x))], t))
                stands[t].add(name)
    return {(name, line) for name, own in has.items() for line, t in own if len(stands[t]) >= lines.MIN_DOCS}


def test_templates_equal_a_plain_tree(spark):
    given = [r for r in rows_of(spark, "documents", "doc_id", "text") if r[1]]
    # one leaf with many templates and lines that share some of them
    made = [(10**6 + k, f"the log says w{chr(97 + k % 23)}a w{chr(97 + k % 7)} u{chr(97 + k % 5)} {'abcdefg'[k % 7]}x tail{'xyz'[k % 3]} end") for k in range(400)]
    docs = [tuple(r) for r in given] + made
    got = lines.recurring(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    want = plain_tree(spark, docs)
    assert want and len(got) == len(want) and {tuple(r) for r in got} == want


def test_looking_up_templates_changes_nothing(monkeypatch):
    rng = np.random.default_rng(5)
    for width in (4, 5, 7, 10, 33):
        base = rng.integers(1, 90, (300, width))
        rows = base[rng.integers(0, 300, 1500)]
        rows[rng.random(rows.shape) < 0.15] = 0
        rows[:, : lines.DEPTH] = 1
        runs = []
        for limit in (1, 32, 10**9):
            monkeypatch.setattr(lines, "INDEXED", limit)
            leaf = lines.Leaf(width, lines.SIMILAR)
            runs.append([leaf.add(k, w) for k, w in enumerate(rows.astype(np.int16))])
        assert runs[0] == runs[1] == runs[2] and (width == 4 or len(set(runs[0])) > 32)


def test_a_large_leaf_is_dealt_to_groups(spark):
    """A third of all distinct lines in one leaf: its groups are bounded, its templates are whole again at the end."""
    letters = [a + b for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst"]
    logs = [(k, f"unit says that {letters[k % 20]} valve {letters[k % 20 + 20]} opened by {letters[k % 397]} for {letters[k // 2000]} now") for k in range(2000)]
    alone = [(5000 + k, " ".join(["unit says that", *(letters[(k * 7 + j * 31 + k * j) % 400] for j in range(1, 10))])) for k in range(300)]
    other = [(10_000 + k, f"{letters[k % 400]} {letters[k // 400]} text of its own words") for k in range(4000)]
    docs = spark.createDataFrame(logs + alone + other, "doc_id bigint, text string")
    whole = {tuple(r) for r in lines.recurring(docs).collect()}
    dealt = {tuple(r) for r in lines.recurring(docs, group=64).collect()}
    assert {d for d, _ in whole} == {d for d, _ in dealt} == {d for d, _ in logs}
    distinct = docs.selectExpr("xxhash64(substr(text, 1, 14)) AS leaf", "xxhash64(text) AS line", "transform(split(text, ' '), w -> cast(pmod(xxhash64(w), 65535) - 32767 AS smallint)) AS codes", "1L AS n")
    for turn in range(lines.BANDS + 1):
        sizes = [r["count"] for r in lines._dealt(distinct, turn, 64).where("open").groupBy("group").count().collect()]
        assert sum(sizes) == 2300 and max(sizes) < 130


def test_templates_of_a_large_leaf_that_stay_apart_meet_by_bands(spark):
    """More templates than a group takes: lines of a template that were dealt apart still find each other."""
    rng = np.random.default_rng(3)
    rows = []
    for t in range(300):
        words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 5)) for _ in range(8)]
        for k in range(6):
            rows.append((len(rows), " ".join(["all of them", *words[:-1], "".join(chr(97 + c) for c in rng.integers(0, 26, 6))])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert lines.recurring(docs, group=16).select("doc_id").distinct().count() == len(rows)


def test_templates_of_a_large_leaf_that_differ_in_every_band_meet(spark):
    """Lines that share 16 of 20 words, with a word of their own in each band of places: no template is left out for that."""
    rng = np.random.default_rng(9)
    word = lambda n: "".join(chr(97 + c) for c in rng.integers(0, 26, n))
    rows = []
    for _ in range(40):
        words = [word(5) for _ in range(17)]
        for k in range(12):
            # every four places in a row are one of each band
            at = 0 if k % 2 else 8
            rows.append((len(rows), " ".join(["all of them", *words[:at], *(word(6) for _ in range(lines.BANDS)), *words[at + lines.BANDS :]])))
    alone = [(10_000 + k, " ".join(["all of them", *(word(5) for _ in range(17))])) for k in range(60)]
    docs = spark.createDataFrame(rows + alone, "doc_id bigint, text string")
    found = {tuple(r) for r in lines.recurring(docs).collect()}
    assert {d for d, _ in found} == {d for d, _ in rows}
    assert {tuple(r) for r in lines.recurring(docs, group=16).collect()} == found


def test_older_templates_are_the_nearest_of_all(spark, monkeypatch):
    """Against a comparison of all pairs: runs that few and that many templates agree in, lines of any width, and lines that meet without runs."""
    rng = np.random.default_rng(4)
    rows = []
    for width in (4, 5, 7, 10, 21):
        base = rng.integers(1, 40, (25, width))
        own = base[rng.integers(0, 25, 120)]
        own[rng.random(own.shape) < 0.2] = 0
        own[:, : lines.DEPTH] = 1
        # one run that very many agree in
        own[:80, lines.DEPTH :][:, :3] = 2
        rows += [(width, int(name), [int(c) for c in codes]) for name, codes in zip(rng.integers(-(2**62), 2**62, 120), own, strict=True)]
    want = {}
    for leaf, name, codes in rows:
        older = [(-sum(a == b for a, b in zip(c, codes, strict=True)), n) for of, n, c in rows if of == leaf and n < name]
        if older and -min(older)[0] >= lines.SIMILAR * len(codes):
            want[leaf, name] = min(older)[1]
    given = spark.createDataFrame(rows, "leaf bigint, line bigint, codes array<smallint>")
    assert len(want) > 300
    for wide, cells in ((256, 2**24), (6, 500)):
        monkeypatch.setattr(lines, "WIDE", wide)
        monkeypatch.setattr(lines, "CELLS", cells)
        for limit in (8, 10_000):
            got = lines._older(given, lines.SIMILAR, limit).collect()
            assert len(got) == len(want) and {(r.leaf, r.line): r.near for r in got} == want


def test_given_columns_of_line_dedup_are_replaced(spark):
    docs = spark.createDataFrame([(1, "a b c d\nx", 7, "p", "q")], "doc_id bigint, text string, n_lines int, line string, template string")
    row = lines.drop_recurring_lines(docs).collect()[0]
    assert (row.n_lines, row.n_dropped, row.line, row.template, row.text) == (2, 0, "p", "q", "a b c d\nx")


def plain_features(text):
    """Words, runs of punctuation and pairs of neighbours, as a unit vector of square roots of counts."""
    import re

    parts = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F\x00-\x08\x0E-\x1F]+", lower(text))
    counts = Counter([*parts, *zip(parts[:-1], parts[1:], strict=True)])
    total = sum(counts.values())
    return {f: (n / total) ** 0.5 for f, n in counts.items()} | {None: 1.0}


def plain_ftrl(rows):
    """Weights after plain updates, coordinate by coordinate."""
    from math import exp, sqrt

    z, n = Counter(), Counter()

    def weight(f):
        if abs(z[f]) <= quality.L1:
            return 0.0
        return -(z[f] - (quality.L1 if z[f] > 0 else -quality.L1)) / ((quality.BETA + sqrt(n[f])) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for x, y in rows:
            own = {f: weight(f) for f in x}
            miss = 1 / (1 + exp(-sum(own[f] * v for f, v in x.items()))) - y
            for f, v in x.items():
                g = miss * v
                z[f] += g - (sqrt(n[f] + g * g) - sqrt(n[f])) / quality.ALPHA * own[f]
                n[f] += g * g
    return {f: weight(f) for f in z}


def test_quality_equals_plain_updates(spark):
    from math import exp

    rng = np.random.default_rng(11)
    vocabulary = np.array(["alpha", "Beta", "gamma7", "δέλτα", "it", "!!", "--", "end.", "(x)", "omega"])
    docs = [(k, " ".join(vocabulary[rng.integers(0, 10, rng.integers(1, 40))])) for k in range(120)] + [(200, ""), (201, None)]
    labels = [(k, int("omega" in text and "!!" in text)) for k, text in docs[:90]]
    assert 10 < sum(y for _, y in labels) < 80
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    weights = quality.fit(frame, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    order = np.argsort(quality.mix64(np.arange(90, dtype=np.uint64)))
    plain = plain_ftrl([(plain_features(docs[k][1]), labels[k][1]) for k in order.tolist()])
    assert sum(w != 0 for w in plain.values()) > 50
    for r in quality.score(frame, weights).collect():
        dot = sum(plain.get(f, 0.0) * v for f, v in plain_features(r.text).items())
        assert abs(r.score - 1 / (1 + exp(-dot))) < 1e-5


def test_lines_are_masked_once(spark):
    """Distinct lines and the documents that hold them are read from one stored table: no text is masked again for the second."""
    docs = spark.createDataFrame([(k, "a b c d 1\nx\ty  z 2 w") for k in range(6)], "doc_id bigint, text string")
    found = lines.recurring(docs)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan and "regexp_replace" not in plan
    assert found.count() == 12
    # odd white space, variables and short lines, in a text that loses lines and in one that does not
    docs = docs.unionByName(spark.createDataFrame([(7, "\r\n a  b\fc d 77 \n\na b c\n"), (8, " q  r 5\t\n")], docs.schema))
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in lines.drop_recurring_lines(docs).collect()}
    assert got == {**{k: ("", 2, 2) for k in range(6)}, 7: ("\r\n\na b c\n", 5, 1), 8: (" q  r 5\t\n", 2, 0)}

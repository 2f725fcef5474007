"""The training-data operators against brute force on small tables with nulls, empty, long and repeated texts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from stumpline.llm import bytescan, common, decontaminate, graph, language_model, lines, packing, quality, sharding, simhash, spotsigs, toxicity, warc
from stumpline.llm.common import labelled_sample, remainder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, n long"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["the", "of", "and", "Été", "don't", "x1", "a-b"] + ["".join(rng.choices("abcdeé", k=rng.randint(2, 6))) for _ in range(150)]
    say = lambda n: " ".join(rng.choices(words, k=n))
    base = [say(rng.randint(1, 60)) + "\nShared line here.\n" + say(12) for _ in range(30)]
    near = [b + " end" for b in base[:6]]
    item = say(14)
    return [None, "", " \n\t", "word", "two words", *base, *base[:5], *near, say(30) + " " + item + " " + say(5), item, "be " * 3000 + item.upper(), say(4000)], item


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 12}" if i % 7 else None, len(t or ""), "x", 1) for i, t in enumerate(texts[0])]
    return spark.createDataFrame(rows, SCHEMA)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 130)] + [(7, 7)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {j: 100 for j in range(100, 130)}


@pytest.mark.parametrize("bucket", [1, 32])
def test_simhash_matches_all_pairs(docs, texts, bucket):
    def fp(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = [fp(t) for t in texts[0]]
    root = list(range(len(prints)))
    for _ in prints:
        for i in root[:]:
            root[i] = min([root[i], *(root[j] for j in range(len(prints)) if (prints[i] ^ prints[j]).bit_count() <= 2)])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs, bucket).collect()}
    assert got == {i: (f"{p:016x}", root[i]) for i, p in enumerate(prints)}


def test_simhash_keeps_one_of_each_group_and_all_columns(docs):
    docs = docs.withColumns({"_id": F.lit(1), "_hash": F.lit(2), "n": F.lit(3), "root": F.lit(4)})
    twice = docs.unionByName(docs.filter("doc_id < 9")).unionByName(docs.filter("doc_id = 7").withColumn("doc_id", F.lit(None).cast("long")))
    kept = corpus_pipeline.simhash_near_dedup(None, twice, "")
    ids = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(ids)


def test_near_duplicates_broadcast_no_table(docs, monkeypatch):
    plans, plan = [], lambda df: df._jdf.queryExecution().executedPlan().toString()

    def noted(df, name, written=simhash.written):
        plans.append(plan(df))
        return written(df, name)

    monkeypatch.setattr(simhash, "written", noted)
    monkeypatch.setattr(common, "MAX_BROADCAST_ROWS", -1)
    for bucket in (1, 32):
        plans.append(plan(simhash.near_duplicates(docs, bucket)))
    plans.append(plan(simhash.keep_one(docs)))
    plans.append(plan(simhash.keep_one(docs.unionByName(docs))))
    assert sum("Join" in p for p in plans) >= 6 and not [p for p in plans if "Broadcast" in p]


def test_decontamination_matches_a_plain_search(spark, docs, texts):
    item = texts[1]
    items = [(1, item), (2, "be"), (3, None), (4, "..."), (10, item), (None, "the")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for i, t in items:
        w = word.findall(low(t))
        for k in range(max(len(w) - 9, 1) if w and i is not None else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(str(i))
    got = {r.doc_id: r for r in decontaminate.hits(docs, bench).collect()}
    for i, t in enumerate(texts[0]):
        w, hit, found = word.findall(low(t)), set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                if (key := tuple(w[k : k + size])) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[key]
        want = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
        assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].items_sha256, got[i].contaminated) == want
    clean = decontaminate.remove_spans(docs, bench)
    assert clean.columns == docs.columns and not decontaminate.hits(clean, bench).filter("contaminated").count()
    assert clean.count() == docs.count()


def test_many_small_benchmark_blocks_give_the_same_and_are_forgotten(spark, docs, texts):
    rng = random.Random(8)
    long = re.findall(r"\S+", texts[0][-1])
    starts = [rng.randrange(len(long) - 12) for _ in range(30)]
    bench = spark.createDataFrame([(i, " ".join(long[a : a + 12])) for i, a in enumerate(starts)] + [(99, texts[1])], "item_id long, text string")
    want = sorted(map(tuple, decontaminate.hits(docs, bench).drop("spans").collect()), key=str)
    got = decontaminate.hits(docs, bench, block_words=20)
    assert sorted(map(tuple, got.drop("spans").collect()), key=str) == want
    blocks = decontaminate.benchmark_blocks(bench, block_words=20)
    assert len(blocks) > 15
    found = decontaminate.search_shard(pa.array(texts[0][-3:]), blocks)
    assert found.hit.any() and not any("_value" in vars(b) for b in blocks)
    cleaned = decontaminate.remove_spans(docs, bench, block_words=20)
    assert not decontaminate.hits(cleaned, bench).filter("contaminated").count()


def test_suffix_order_is_that_of_sorted_suffixes():
    rng = np.random.default_rng(1)
    for _ in range(30):
        sizes = rng.integers(1, 40, 6)
        left = np.concatenate([np.arange(s, 0, -1) for s in sizes])
        symbol = rng.integers(1, rng.integers(2, 6), len(left)).astype(np.int32)
        want = sorted(range(len(left)), key=lambda i: (symbol[i : i + left[i]].tolist(), i))
        assert decontaminate.suffix_order(symbol, left).tolist() == want


def test_packing_round_trip(docs, texts):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path(packing.TOKENIZER))
    want = {}
    for i, t in enumerate(texts[0]):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for k, a in enumerate(range(0, len(ids), 4096)):
            want[i, k] = (a, len(ids[a : a + 4096]), zlib.crc32(np.array(ids[a : a + 4096], "<u4").tobytes()))
    rows = packing.pack(docs).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    at = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at[r.sequence_id]
        at[r.sequence_id] += r.length
    assert max(at.values()) <= 4096 and len(at) <= math.ceil(sum(at.values()) / 4096) + 1


def test_many_counts_are_not_broadcast_and_give_the_same(docs, monkeypatch):
    want = sorted(packing.pack(docs).collect())
    monkeypatch.setattr(common, "MAX_BROADCAST_ROWS", 0)
    got = packing.pack(docs)
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString() and sorted(got.collect()) == want


def test_parts_are_tokenised_as_the_whole_text():
    from public_tokenizers import path

    ids = packing.WordIds(path(packing.TOKENIZER))
    odd = ["It's 5% e.g. don't <|endoftext|> <|ENDOFTEXT|> H̱ x́. İ ß. café's l'été! …wow... 12.5€ \x1cq\x1d", "'S 'RE we'LL .'s !!'t", "한국어 中文! ²³ ½ Ⅷ", "a!b?c'd"]
    for text, got in zip(odd, ids([t.encode() for t in odd]), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == ids.tokenizer.encode(text, add_special_tokens=False).ids


def test_patterns_use_every_document_and_replace_the_smallest():
    found = packing.patterns({6: 3, 3: 2, 2: 4, 5: 2}, capacity=10)
    used = Counter()
    for many, content in found:
        assert sum(s * k for s, k in content) <= 10
        used.update({s: k * many for s, k in content})
    assert used == {6: 3, 3: 2, 2: 4, 5: 2}
    assert packing.patterns({7: 1, 2: 1, 6: 0}, 10) == [(1, [(7, 1), (2, 1)])]


def test_language_model_counts_and_normalisation(docs, texts, monkeypatch):
    monkeypatch.setattr(language_model, "COMMON", 60)
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", low(t)) + [None] for t in texts[0]]
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(tokens))]
    c = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    n, v = sum(c.values()), len(c)
    got = {r.doc_id: r for r in language_model.scores(docs).collect()}
    for i, t in enumerate(tokens):
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), sum(c[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(base) and r.score < 0
    model, _ = language_model.train(docs)
    assert np.allclose((10.0 ** model.table.astype(float)).sum(1), 1, atol=1e-4)


def test_lines_on_many_sites_go_but_for_the_first(docs, texts):
    got = {r.doc_id: r.text for r in lines.remove_spread(docs, sites=4).collect()}
    kept = [i for i, t in got.items() if t and "Shared line here." in t.split("\n")]
    assert kept == [5] and got[0] is None and set(got) == set(range(len(texts[0])))


def test_shards_fit_and_levels_agree(docs):
    fine, coarse = ({r.doc_id: r for r in sharding.assign(docs, 3000, b).collect()} for b in (3, 12))
    assert {i: r.shard for i, r in fine.items()} == {i: r.shard for i, r in coarse.items()}
    size = Counter()
    for r in fine.values():
        size[r.shard] += r.bytes
    assert all(size[r.shard] == r.shard_bytes and (r.shard_bytes <= 3000 or r.over_limit) for r in fine.values())
    names = sorted(size)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:], strict=False))


def test_warc_round_trip_with_revisits(spark):
    html = [None, "", "<p>x</p>", "<p>x</p>", "a\r\n\r\nWARC/1.1\r\n", "é" * 70_000, "<p>x</p>"]
    pages = spark.createDataFrame([(i, f"http://h{i % 3}.org/p" if i else None, h) for i, h in enumerate(html)], "page_id long, url string, html string")
    rows = {r.page_id: r for r in warc.round_trip(pages).collect()}
    first = {}
    for i, h in enumerate(html):
        f = first.setdefault(h or "", i)
        r = rows[i]
        assert (r.payload_bytes, r.record_type, r.refers_to, r.intact) == (len((h or "").encode()), "revisit" if f < i else "response", f if f < i else None, True)
    order = sorted(rows.values(), key=lambda r: r.position)
    assert [(r.url_key, r.captured) for r in order] == sorted((r.url_key, r.captured) for r in order)


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    sizes = [50] * 30 + [9_000] * 10 + [30_000] * 6 + [200_000]
    pages = spark.createDataFrame([(i, f"http://h{i % 3}.org/{i}", f"{i:06}" + "x" * n) for i, n in enumerate(sizes)], "page_id long, url string, html string").coalesce(1)
    warc.write_archives(warc.captures(pages), str(tmp_path / "out"), archive_records=16, archive_bytes=320_000)
    seen, counts = [], []
    for file in (tmp_path / "out").glob("*.gz"):
        found = [(h["X-URL-Key"], int(h["X-Payload-Length"])) for h, _ in warc.records(file.read_bytes())]
        assert found == sorted(found) and len(found) <= 16 and sum(n for _, n in found) <= 320_000
        seen += [n for _, n in found]
        counts.append(len(found))
    assert sorted(seen) == sorted(n + 6 for n in sizes) and max(counts) == 16
    assert warc.read_archives(spark.read.format("binaryFile").load(str(tmp_path / "out"))).filter("intact").count() == len(sizes)


def test_captures_with_one_key_are_merged_in_several_ranges(spark, tmp_path):
    pages = spark.createDataFrame([(None, "http://a.org/", "same")] * 900 + [(i, "http://a.org/", str(i)) for i in range(20)], "page_id long, url string, html string")
    warc.write_archives(warc.captures(pages.repartition(4)), str(tmp_path / "out"), archive_records=100)
    index = warc.read_archives(spark.read.format("binaryFile").load(str(tmp_path / "out")))
    rows = warc.merged_history(index).collect()
    assert sorted(r.position for r in rows) == list(range(920))
    order = [(r.captured, r.page_id is not None, r.page_id or 0, r.run, r.seq) for r in sorted(rows, key=lambda r: r.position)]
    assert order == sorted(order)
    assert max(Counter(r.range for r in rows).values()) < 500


def test_loser_tree_merges_runs():
    rng = random.Random(2)
    for k in (1, 2, 5, 8):
        runs = [sorted((rng.randint(0, 9),) for _ in range(rng.randint(0, 7))) for _ in range(k)]
        assert [runs[r][p] for r, p in warc.merge_runs(runs)] == sorted(x for r in runs for x in r)


def test_spotsigs_edited_texts_and_pairs(docs, texts):
    got = {r.doc_id: r for r in spotsigs.edited_likeness(docs).collect()}
    order = sorted(range(len(texts[0])), reverse=True)
    for i, j in zip(order, [*order[1:], order[0]], strict=True):
        t, after = texts[0][i] or "", texts[0][j] or ""
        n = len(t)
        assert got[i].n_chars == n and got[i].edited_sha256 == hashlib.sha256((t[: n - n // 3] + after[: n // 3]).encode()).hexdigest()
    # Fingerprints from a plain reading of the texts, and likenesses from these.
    prints = {i: plain_spots(t) for i, t in enumerate(texts[0])}
    same = {}
    for i, spots in prints.items():
        same.setdefault(frozenset(spots), set()).add(got[i].fingerprint)
        assert len(got[i].fingerprint.split(",")) == len(spots) or not spots
    assert all(len(v) == 1 for v in same.values()) and len({v for x in same.values() for v in x}) == len(same)
    jaccard = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for i, j in zip(order, [*order[1:], order[0]], strict=True):
        t, after = texts[0][i] or "", texts[0][j] or ""
        edited = plain_spots(t[: len(t) - len(t) // 3] + after[: len(t) // 3])
        assert (got[i].near_edited, got[i].near_next) == (pytest.approx(jaccard(prints[i], edited)), pytest.approx(jaccard(prints[i], prints[j])))
    classes, pairs = spotsigs.near_pairs(docs.unionByName(docs.filter("doc_id = 9").withColumn("doc_id", F.lit(None).cast("long"))))
    of = {r.doc_id: r.class_id for r in classes.collect()}
    assert of[None] == of[9]
    sets = {i: frozenset(r.fingerprint.split(",")) for i, r in got.items() if r.fingerprint}
    named = {of[i]: s for i, s in sets.items()}
    want = {frozenset((sets[a], sets[b])) for a in sets for b in sets if sets[a] != sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert {frozenset((named[r.a], named[r.b])) for r in pairs.collect()} == want


def plain_spots(text):
    """Chains of an anchor and the next two content words among the eight words after it."""
    words = [w for w in re.split(r"[\s!-/:-@\[-`{-~]+", (text or "").lower())]
    content = lambda w: w != "" and w not in spotsigs.ANCHORS
    anchors = any(w in spotsigs.ANCHORS for w in words)
    out = set()
    for i, w in enumerate(words):
        if w in spotsigs.ANCHORS if anchors else w != "":
            out.add((w, *[x for x in words[i + 1 : i + 9] if content(x)][:2]))
    return out


def test_spotsigs_gives_a_row_for_every_copy(spark):
    rows = [(1, "the cat sat"), (1, "the cat sat"), (2, "and a dog"), (None, "x"), (None, "x"), (1, "other words"), (3, None), (3, "")] + [(7, "of mice and men")] * 2500
    got = spotsigs.edited_likeness(spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit("x"), "hash": F.lit(1)}))
    count = Counter((r.doc_id, r.n_chars) for r in got.collect())
    assert count == Counter((i, len(t or "")) for i, t in rows)


def test_classifiers_learn_a_planted_word(spark):
    rng = random.Random(3)
    say = lambda: " ".join("".join(rng.choices("abcde", k=3)) for _ in range(40))
    rows = [(i, say() + (" vilest " if i % 4 == 0 else " kind ") + say()) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))
    labels = spark.createDataFrame([(i, int(i % 4 != 0), int(i % 4 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    for r in toxicity.scores(docs, labels).collect():
        assert r.predicted == int(r.doc_id % 4 == 0)
    model = quality.train(docs, labels)
    good, bad = (quality.score_array(pa.array([say() + w]), model)[0] for w in (" kind", " vilest"))
    assert good > bad
    assert len(quality.score_array(pa.array([None, ""]), model)) == 2
    assert toxicity.best_threshold(np.array([0.1, 0.9]), np.array([0, 1])) == pytest.approx(0.5)


def test_hashes_tell_words_apart_and_do_not_depend_on_place():
    data, offsets = bytescan.utf8(pa.array(["ab cd ab", None, "", "cd"]))
    starts, ends, row = bytescan.spans(data, offsets, bytescan.NOT_SPACE)
    h = bytescan.hashes(data, starts, ends)
    assert row.tolist() == [0, 0, 0, 3] and h[0] == h[2] and h[1] == h[3] and h[0] != h[1]


def test_toxicity_skips_only_the_labelled_text_that_does_not_fit(spark, monkeypatch):
    rows = [(i, "bad words" if i % 2 else "good words", "en") for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    taken = [r.doc_id for r in table.filter(remainder("doc_id", 5) != 0).orderBy(F.xxhash64("doc_id", F.lit("sample"))).collect()]
    long = table.withColumn("text", F.when(F.col("doc_id") == taken[0], F.repeat(F.lit("long "), 500)).otherwise(F.col("text")))
    monkeypatch.setattr(toxicity, "FIT_WORDS", 400)
    net = toxicity.train(long, labels)
    bad, good = toxicity.score_array(pa.array(["bad words", "good words"]), net)
    assert bad > 0.5 > good


def test_a_labelled_id_with_many_rows_gives_one_text(spark):
    table = spark.range(400).select(F.when(F.col("id") < 300, 1).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"))
    labels = spark.createDataFrame([(1, 1), *((i, 0) for i in range(300, 400))], "doc_id long, toxic int")
    got = labelled_sample(table, labels, "toxic", 8000, extra=("lang",)).collect()
    want = labels.filter(remainder("doc_id", 5) != 0).count()
    first = table.filter("doc_id = 1").orderBy(F.xxhash64("text")).first().text
    assert len(got) == want and [r._text for r in got if r._label == 1] == [first] * (zlib.crc32(b"1") % 5 != 0)


def test_language_model_knows_the_end_beyond_the_broadcast_words(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(300)) + " twice twice"
    rows = spark.createDataFrame([(i, text) for i in range(3) if zlib.crc32(str(i).encode()) % 10], "doc_id long, text string")
    monkeypatch.setattr(language_model, "COMMON", 10_000)
    want = language_model.scores(rows).first()
    monkeypatch.setattr(language_model, "COMMON", 0)
    got = language_model.scores(rows).first()
    assert want.n_known == want.n_tokens == got.n_known
    assert math.isclose(got.base_score, want.base_score) and math.isclose(got.score, want.score, rel_tol=1e-6)


def test_empty_tables(spark, docs):
    none, bench, labels = docs.limit(0), spark.createDataFrame([], "item_id long, text string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert simhash.near_duplicates(none).count() == 0
    assert decontaminate.hits(none, bench).count() == 0
    assert packing.pack(none).count() == 0
    assert language_model.scores(none).count() == 0
    assert lines.digest(none).count() == 0
    assert sharding.assign(none).count() == 0
    assert spotsigs.edited_likeness(none).count() == 0
    assert quality.scores(none, labels).count() == 0
    assert toxicity.scores(none, labels).count() == 0
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pipeline_stages_keep_columns(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "best_fit_packing" and corpus_pipeline.ORACLE_SQL is None
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(f"{tmp_path}/{i}")
        after = spark.read.parquet(f"{tmp_path}/{i}")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns and 0 < after.count() <= docs.count()
        docs = after
    assert docs.count() > 0

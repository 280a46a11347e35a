"""The operators on small tables with nulls, empty and long texts, repeated rows, clashing columns and no rows."""

import hashlib
import math
import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.test_units import brute_fingerprint
from tidemark.llm import (chat, crossentropy, decontaminate, digest, html, pieces, quality, queries, simhash, toxicity, urls)

SF = "/root/testdata/sf0.001"
BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon " * 3
TEXTS = [
    (1, BASE), (2, BASE), (3, BASE + "omega"), (4, None), (5, ""), (6, "  "), (7, "One two"), (7, "One two"),
    (8, "quite other words stand here and say nothing at all"), (None, "no id"), (9, "x" * 200_000), (10, BASE.upper()),
]
LABELS = [(1, 1, 0), (2, 0, 0), (2, 1, 0), (3, 0, 1), (5, None, None), (None, 1, 1), (8, 1, 0), (10, 0, 1)]


@pytest.fixture
def docs(frame):
    # columns whose names clash with what operators use inside
    rows = [(i, t, "x", "y", 0, 1.0, "r") for i, t in TEXTS]
    return frame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, row string")


@pytest.fixture
def labels(frame):
    return frame(LABELS, "doc_id bigint, quality int, toxic int")


def brute_components(rows):
    prints = [brute_fingerprint(t or "") for _, t in rows]
    left, group = set(range(len(rows))), {}
    while left:
        queue, seen = [left.pop()], set()
        while queue:
            k = queue.pop()
            seen.add(k)
            near = {j for j in left if (prints[j] ^ prints[k]).bit_count() <= 2}
            left -= near
            queue += near
        least = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
        group.update({k: least for k in seen})
    return sorted(((rows[k][0], f"{prints[k]:016x}", group[k]) for k in range(len(rows))), key=repr)


@pytest.mark.parametrize("leaf_rows", [1 << 14, 1])
def test_simhash(docs, leaf_rows):
    found = simhash.near_duplicates(docs, leaf_rows=leaf_rows)
    rows = found.select("doc_id", simhash.hex_digits(F.col("fp")), "component_id").collect()
    assert sorted(map(tuple, rows), key=repr) == brute_components(TEXTS)


def test_components_of_a_long_chain(frame):
    links = frame([(k, k + 1) for k in range(60)] + [(100, 200)], "u bigint, v bigint")
    found = {r["vertex"]: r["root"] for r in simhash.components(links).collect()}
    assert len({found[k] for k in range(61)}) == 1 and found[100] == found[200] != found[0] and len(found) == 63


def test_keep_one(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    wanted = {c for _, _, c in brute_components(TEXTS)}
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted(wanted, key=repr)


def test_keep_one_of_components_that_share_an_id(frame):
    other, third = "quite other words stand here and say nothing at all", "a third text is unlike the two before it in each of its words"
    rows = [(None, BASE), (None, other), (None, other), (7, BASE[:60]), (7, third), (7, third), (8, third)]
    kept = simhash.keep_one(frame(rows, "doc_id bigint, text string"))
    assert len({brute_fingerprint(t) for _, t in rows}) == 4
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted({(None, BASE), (None, other), (7, BASE[:60]), (7, third)}, key=repr)


def test_keep_one_with_maps_and_named_documents(frame):
    rows = [("a", BASE, {"k": 1}), ("b", BASE, {"k": 2}), ("c", "quite other words stand here and say nothing at all", None),
            ("c", "quite other words stand here and say nothing at all", {"k": 3}), (None, BASE + "omega", {})]
    docs = frame(rows, "doc_id string, text string, tags map<string, int>")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    named = sorted((r["doc_id"], r["text"]) for r in kept.collect() if r["doc_id"])
    assert named == [("a", BASE), ("c", rows[2][1])]
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert found["a"] == found["b"] == "a" and found["c"] == "c"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")
def test_simhash_on_the_test_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op10_simhash(spark, SF).collect()), key=repr) == brute_components(rows)


def brute_digest(text):
    """The digest by counting triplets one by one."""
    raw = text.encode()
    counts = Counter((int.from_bytes(raw[k:k + 3], "big") * 2654435761 & 0xFFFFFFFF) >> 24 for k in range(len(raw) - 2))
    held = [counts[k] for k in range(256)]
    limits = [sorted(held)[k] for k in (63, 127, 191)]
    ratios = "".join(f"{15 * q // limits[2] if limits[2] else 0:x}" for q in limits[:2])
    bits = "".join(f"{sum(c > q for q in limits):02b}" for c in held)
    return f"{min(255, round(math.log(len(raw) + 1) / math.log(1.1))):02x}{ratios}{int(bits, 2):0128x}"


def brute_likeness(a, b):
    codes = [[int(c, 16) >> s & 3 for c in d[4:] for s in (2, 0)] for d in (a, b)]
    bits = sum((0, 1, 3, 6)[abs(x - y)] for x, y in zip(*codes))
    apart = min(abs(int(a[:2], 16) - int(b[:2], 16)), 32) + sum(abs(int(a[k], 16) - int(b[k], 16)) for k in (2, 3))
    return 1 - (bits + apart) / (256 * 6 + 32 + 2 * 16)


def brute_edits(rows):
    """The results for rows in order of id (null first) and text hash."""
    texts = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()))
    found = []
    for (ident, text), (_, following) in zip(texts, texts[1:] + texts[:1]):
        half = len(text) // 2
        other = text[:len(text) - half] + following[:half]
        prints = [brute_digest(t) for t in (text, other, following)]
        found.append((ident, len(text), hashlib.sha256(other.encode()).hexdigest(), prints[0], prints[1],
                      pytest.approx(brute_likeness(*prints[:2])), pytest.approx(brute_likeness(prints[0], prints[2]))))
    return found


def edits_of(frame_, **kwargs):
    rows = [tuple(r) for r in digest.compare_with_edited(frame_, **kwargs).collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))


@pytest.mark.parametrize("part_bytes", [1, 200, 16 << 20])
def test_digests_equal_brute_force(docs, part_bytes):
    wanted = sorted(brute_edits([(i, t) for i, t in TEXTS]), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    assert edits_of(docs, part_bytes=part_bytes) == wanted


def test_digests_of_a_table_equal_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    wanted = sorted(brute_edits([tuple(r) for r in rows.collect()]), key=lambda r: (r[0], r[2]))
    assert edits_of(rows) == wanted


def test_digests_of_one_document_and_of_one_id(spark, frame):
    assert edits_of(frame([(3, "abcdef")], "doc_id bigint, text string")) == brute_edits([(3, "abcdef")])
    rows = [(7, f"text number {k} of one id " * 9) for k in range(400)]
    hot = frame(rows, "doc_id bigint, text string")
    assert edits_of(hot) == sorted(brute_edits(rows), key=lambda r: r[2])
    assert digest.in_order(hot, 1 << 20).select(F.spark_partition_id().alias("part")).distinct().count() > 1
    equal = spark.range(0, 4000, 1, 8).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("one text").alias("text"))
    assert digest.in_order(equal, 1 << 20).select(F.spark_partition_id().alias("part")).distinct().count() > 1


def test_successors_over_runs(spark):
    numbers = [0, 1, 5, 6, 7, 20, 21, 40]
    found = digest.successors(spark.createDataFrame([(n,) for n in numbers], "part int"), run=4).collect()
    assert dict(map(tuple, found)) == dict(zip(numbers, numbers[1:] + numbers[:1]))


def test_classifiers_take_every_row(docs, labels):
    for scored in (quality.score_quality(docs, labels), toxicity.score_toxicity(docs, labels)):
        rows = scored.collect()
        assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    for kept in (quality.drop_poor(docs, labels, threshold=0.0), toxicity.drop_toxic(docs, labels, threshold=1.1)):
        assert kept.columns == docs.columns and kept.count() == len(TEXTS)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="test tables absent")
def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    for query, label, least in ((queries.op3_quality, "quality", 0.98), (queries.op9_toxicity, "toxic", 0.97)):
        held = query(spark, sf).join(labels, "doc_id").where("held_out")
        assert held.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0] >= least


def test_cross_entropy(docs, frame):
    rows = {r["doc_id"]: r for r in crossentropy.score_documents(docs, frame([(1,), (1,), (None,), (99,)], "doc_id bigint")).collect()}
    assert len(rows) == len({i for i, _ in TEXTS}) and rows[4]["n_tokens"] == rows[5]["n_tokens"] == 0 and rows[4]["score"] == 0.0
    assert rows[1]["score"] < rows[8]["score"]
    # against counts by hand
    texts = [t or "" for _, t in TEXTS]
    words = [t.lower().split() for t in texts]
    total = sum(map(len, words))
    single = sum(w.count("quite") for w in words)
    p = (single + 1) / (total + crossentropy.WORDS)
    word, pair = crossentropy.slots("quite")
    model = crossentropy.BigramModel(*[__import__("numpy").zeros(n, "f4") for n in (crossentropy.WORDS, crossentropy.PAIRS)], float(total))
    model.words[word] = single
    assert abs(model.losses(word, pair, word * 0 - 1)[0] + __import__("math").log2(p)) < 1e-5


def brute_losses(rows, targets):
    words = [(t or "").encode().lower().split() for _, t in rows]
    vocabulary, losses = len({w for ws in words for w in ws}), {}
    for side, chosen in (("background", words), ("target", [w for (i, _), w in zip(rows, words) if i in targets])):
        single, pairs = Counter(w for ws in chosen for w in ws), Counter(p for ws in chosen for p in zip(ws, ws[1:]))
        total = single.total() + vocabulary
        p = {w: (single[w] + 1) / total for ws in words for w in ws}
        losses[side] = [sum(-math.log2(p[w] if u is None else (pairs[u, w] + 4 * p[w]) / (single[u] + 4)) for u, w in zip([None, *ws], ws))
                        / max(1, len(ws)) for ws in words]
    return [(i, len(w), t, b) for (i, _), w, t, b in zip(rows, words, losses["target"], losses["background"])]


def test_cross_entropy_counts_every_word_and_pair(frame):
    # more words than 2^18, long ones alike at both ends, a pair in every text, several blocks and ranges
    texts = [(k, f"the end abcdefgh{k % 7}middle{k % 3}abcdefgh " + " ".join(f"w{k * 700 + j}" for j in range(700))) for k in range(400)]
    texts += [(None, "The end"), (5, None), (3, "the END w1 w2"), (3, "the END w1 w2"), (9, "w1"), (10, "É é x")]
    got = crossentropy.score_documents(frame(texts, "doc_id bigint, text string"), frame([(k,) for k in (3, 3, 17, 200, 9999)], "doc_id bigint"),
                                       block_bytes=1 << 17, range_tokens=1 << 11)
    wanted = brute_losses(texts, {3, 17, 200})
    rows = sorted(map(tuple, got.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    wanted.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert len(rows) == len(wanted)
    for row, (ident, n, target, background) in zip(rows, wanted):
        assert row[:2] == (ident, n) and row[2:] == pytest.approx((target, background, target - background), abs=1e-9)


def test_cross_entropy_moves_no_block(spark, frame, monkeypatch):
    plans, keep = {}, crossentropy.stored

    def plan(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return keep(df, name)

    monkeypatch.setattr(crossentropy, "stored", plan)
    before = spark.catalog.listTables()
    texts = [(k, f"the end w{k} w{k + 1}") for k in range(40)]
    got = crossentropy.score_documents(frame(texts, "doc_id bigint, text string"), frame([(3,)], "doc_id bigint"), block_bytes=64)
    # the marks and the requests move, then the answers; the words of the blocks in neither
    assert "hashpartitioning(of#" in plans["answers"] and "hashpartitioning(block#" not in plans["answers"]
    assert got._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(") == 1
    assert got.count() == 40 and spark.catalog.listTables() == before


def test_cross_entropy_asks_a_range_once():
    words = [crossentropy.numbered(t, known) for known in [{}] for t in ("a b a c", "b a")]
    hashes = crossentropy.np.arange(1, 4, dtype="u8") << crossentropy.np.uint64(62)
    rows = crossentropy.pa.table({"block": [5] * 3, "place": [crossentropy.HEAD, 0, 1], "doc_id": [None, 1, 2], "n_tokens": [0, 4, 2],
                                  "words": [hashes.tobytes(), *(crossentropy._packed(w, "<i4") for w in words)]})
    asked = crossentropy._requests_of(2)(rows, crossentropy.pa.table({"of": [5], "at": crossentropy.pa.array([1], "int32")})).to_pylist()
    assert len({r["part"] for r in asked}) == len(asked) and sum(r["n_words"] for r in asked) == 3
    counts = crossentropy.np.hstack([crossentropy._unpacked(r["counts"]).reshape(2, -1) for r in asked])
    # words 6 and pairs 4 of all documents, 2 and 1 of the target
    assert counts.sum(axis=1).tolist() == [10, 3] and counts.shape[1] == 3 + 3


def test_urls(frame):
    pages = frame([(1, "http://A.Example.NET/en/x?q#f"), (2, "https://b.example.net/fr/"), (3, "x://a.example.com/de/1"),
                   (4, "http://c.org/fr/a"), (5, None), (6, "no scheme"), (7, "http://net"), (8, "http://bnet/x"), (8, "http://bnet/x"),
                   (None, "http://d.example.org/é#x")], "page_id bigint, url string")
    got = sorted((tuple(r)[:4] for r in urls.judge_urls(pages.withColumn("host", F.lit(1))).collect()), key=repr)
    assert got == sorted([
        (1, "a.example.net", "/en/x", "example.net/en/"), (2, "b.example.net", "/fr/", "net/"), (3, "a.example.com", "/de/1", "example.com/de/"),
        (4, "c.org", "/fr/a", "org/fr/"), (5, "", "", None), (6, "", "", None), (7, "net", "", None), (8, "bnet", "/x", None),
        (8, "bnet", "/x", None), (None, "d.example.org", "/é", None)], key=repr)
    verdicts = {r["rule"]: r["verdict"] for r in urls.judge_urls(pages).collect() if r["rule"]}
    assert verdicts == {"example.net/en/": "allow", "net/": "block", "example.com/de/": "block", "org/fr/": "allow"}


def brute_ratios(decided, texts):
    """Ratios by counts kept per context in dictionaries."""
    def symbols(text):
        return [96] * 5 + [c - 32 if 32 <= c < 127 else 95 for c in text.encode()] + [96]

    counts = {"allow": {}, "block": {}}
    for text, verdict in decided:
        row = symbols(text)
        for at in range(5, len(row)):
            for order in range(6):
                counts[verdict].setdefault(tuple(row[at - order:at]), Counter())[row[at]] += 1
    found = []
    for text in texts:
        row, apart = symbols(text), 0.0
        for at in range(5, len(row)):
            for side, sign in (("allow", 1), ("block", -1)):
                p = 1 / 97
                for order in range(6):
                    seen = counts[side].get(tuple(row[at - order:at]))
                    if seen:
                        p = (seen[row[at]] + len(seen) * p) / (seen.total() + len(seen))
                apart += sign * math.log(p)
        found.append(apart / (len(row) - 5))
    return found


def test_url_ratios_count_exact_contexts(frame):
    # far more than 8,192 contexts of five symbols
    def name(k):
        return hashlib.md5(str(k).encode()).hexdigest()

    hosts = [f"{name(k)[:9]}.example.net/en/{name(-k)}" for k in range(250)] + [f"{name(k)}.example.com/de/{name(k)[:20]}" for k in range(250, 500)]
    free = [f"{name(k)}.test/{name(k)[:7]}" for k in range(0, 500, 50)] + ["é", "", "", hosts[0].replace("net/en", "test/en")]
    pages = frame([(k, f"http://{u}") for k, u in enumerate(hosts + free)], "page_id bigint, url string")
    got = {r["page_id"]: r for r in urls.judge_urls(pages).collect()}
    assert len(got) == len(hosts + free)
    decided = [(r["host"] + r["path"], r["verdict"]) for r in got.values() if r["rule"]]
    assert len(decided) == 500 and len({u[k:k + 5] for u, _ in decided for k in range(len(u))}) > urls.SYMBOLS * 100
    order = sorted(got)
    wanted = brute_ratios(decided, [got[k]["host"] + got[k]["path"] for k in order])
    assert [got[k]["ratio"] for k in order] == pytest.approx(wanted, abs=1e-9)


def test_contaminated(docs, frame):
    bench = frame([(1, BASE[:80]), (2, None), (None, "one two"), (3, "one, TWO!")], "item_id bigint, text string")
    rows = {(r["doc_id"]): r for r in decontaminate.contaminated_documents(docs, bench).collect()}
    assert rows[7]["items"] == ["3"] and rows[7]["contaminated"] and rows[7]["n_hit"] == 2
    assert rows[1]["items"] == ["1"] and not rows[4]["contaminated"] and rows[4]["n_words"] == 0
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 4, 5, 6, 8, 9]


def brute_contamination(text, items, width=13):
    """Words, hit words and named items by comparing every window with every place."""
    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    words, hit, named = split(text), set(), set()
    for ident, item in items:
        known = split(item)
        for k in range(max(1, len(known) - width + 1) if known else 0):
            window = known[k:k + width]
            for at in range(len(words) - len(window) + 1):
                if words[at:at + len(window)] == window:
                    hit |= set(range(at, at + len(window)))
                    named |= {str(ident)} - {"None"}
    return len(words), len(hit), sorted(named)


@pytest.mark.parametrize("max_bytes", [1 << 20, 200, 3])
def test_contamination_by_parts_and_without_ids(docs, frame, max_bytes):
    items = [(1, BASE[:80]), (2, None), (None, "one two"), (3, "quite other words"), (4, BASE[60:200]), (None, "no ID"), (5, ""), (4, "x" * 40)]
    bench = frame(items, "item_id bigint, text string")
    got = decontaminate.contaminated_documents(docs, bench, max_bytes=max_bytes).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got), key=repr) == sorted(
        ((i, *brute_contamination(t, items)) for i, t in TEXTS), key=repr)
    whole = decontaminate.contaminated_documents(docs, bench).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, whole))
    kept = decontaminate.drop_contaminated(docs, bench, max_bytes=max_bytes)
    assert kept.columns == docs.columns and kept.count() == sum(not r["contaminated"] for r in whole)


def test_pages_and_chat(frame):
    pages = frame([(1, "u", "<article><p>a  b</article>"), (1, "u", "<article><p>a  b</article>"), (2, None, None), (None, "v", "")],
                  "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    assert sorted((r["text"], r["n_chars"]) for r in html.extract_pages(pages).collect()) == [("", 0), ("", 0), ("a b", 3), ("a b", 3)]
    turns = frame([(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, None, None, None), (None, 1, "assistant", "<|im_end|>"), (2, 1, "user", "")],
                  "conv_id bigint, turn bigint, role string, text string")
    rows = {r["conv_id"]: r for r in chat.format_conversations(turns).collect()}
    assert rows[1]["n_turns"] == 3 and rows[1]["loss_chars"] == 1 and rows[None]["loss_chars"] == 10
    assert rows[1]["turns_sha256"] == hashlib.sha256(b"\n\nuser\na\nassistant\nb\n").hexdigest()
    assert chat.formatted_turns(turns).count() == 5


def test_segmentations(docs):
    rows = pieces.encode_documents(docs).collect()
    assert {r["doc_id"] for r in rows} == {i for i, _ in TEXTS}
    assert all(r["round_trip"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(tuple(r["ids"]))
    assert len(by[1]) == len(set(by[1])) == pieces.SAMPLES and by[4] == [()] and len(by[7]) == 2 * pieces.SAMPLES


def test_empty_tables(docs, labels, frame):
    none = docs.limit(0)
    bench = frame([], "item_id bigint, text string")
    assert simhash.near_duplicates(none).count() == digest.compare_with_edited(none).count() == 0
    assert quality.score_quality(none, labels).count() == toxicity.score_toxicity(none, labels.limit(0)).count() == 0
    assert crossentropy.score_documents(none, labels.select("doc_id")).count() == pieces.encode_documents(none).count() == 0
    assert decontaminate.contaminated_documents(none, bench).count() == 0
    assert decontaminate.contaminated_documents(docs, bench).where("contaminated").count() == 0
    assert simhash.keep_one(none).count() == 0
    assert urls.judge_urls(frame([], "page_id bigint, url string")).count() == 0
    assert html.extract_pages(frame([], "page_id bigint, url string, html string")).count() == 0
    assert chat.format_conversations(frame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")
def test_pipeline(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality", "toxicity", "near_duplicates", "decontamination", "segmentation"]
    rows = P.run(spark, SF)
    kept = {r["doc_id"] for r in rows.select("doc_id").distinct().collect()}
    # every stage by its operator's own decisions
    good = quality.score_quality(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").select("doc_id")
    calm = toxicity.score_toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 0").select("doc_id")
    left = docs.join(good, "doc_id", "left_semi").join(calm, "doc_id", "left_semi")
    texts = [(r["doc_id"], r["text"]) for r in left.collect()]
    first = {c for _, _, c in brute_components(texts)}
    dirty = {r["doc_id"] for r in queries.op5_decontaminate(spark, SF).where("contaminated").collect()}
    assert kept == first - dirty and rows.where("NOT round_trip").count() == 0

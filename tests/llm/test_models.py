"""The trained operators held against plain versions: features, counts, optimum, gradient, threshold and verdicts."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import common, quality, toxicity, urls

GOOD = "The {0} of the river follows a valley that was formed slowly, and people near {1} still build their houses there."
POOR = "buy {0} now now now!!! click {1} click click best price best price {0} {0}"
WORDS = "amber birch cedar delta ember fjord grove heath inlet jetty knoll larch".split()


def texts(n, seed=3):
    """Rows of id, text and label."""
    draw = np.random.default_rng(seed)
    return [(k, (GOOD, POOR)[k % 2].format(*draw.choice(WORDS, 2)) + f" {k}", 1 - k % 2) for k in range(n)]


def plain_slots(text):
    """The indicators by one pass in plain Python."""
    raw, found = text.encode(), set()
    for k in range(len(raw) - 2):
        found.add((int.from_bytes(raw[k:k + 3], "big") * 2654435761 & 0xFFFFFFFF) >> 16)
    words, shapes = raw.split(), []
    for k, w in enumerate(words):
        echo = 2 if k and words[k - 1] == w else int(any(k >= b and words[k - b] == w for b in (2, 3, 4)))
        shapes.append(3 * echo + (len(w) > 3) + (len(w) > 8))
    for k in range(len(words)):
        run = [0] * max(0, 3 - k) + shapes[max(0, k - 3):k + 1]
        found.add((1 << 16) + sum(s * 9 ** (3 - i) for i, s in enumerate(run)))
    if words:
        levels = (len(set(words)) / len(words), sum(s >= 6 for s in shapes) / len(words))
        for base, share in zip((quality.SLOTS - 32, quality.SLOTS - 16), levels):
            found.update(range(base, base + int(15 * share) + 1))
    return sorted(found)


@pytest.mark.parametrize("text", ["", " ", "ab", "one", *(t for _, t, _ in texts(6)), "a a a b a b a", "ünï 中文 " * 5])
def test_indicators(text):
    assert quality.indicators(text).tolist() == plain_slots(text)


def plain_ratios(rows, positive):
    counts = [Counter(s for r, p in zip(rows, positive) for s in r if p == side) for side in (False, True)]
    totals = [sum(c.values()) + quality.SLOTS for c in counts]
    return {s: math.log((counts[1][s] + 1) / totals[1]) - math.log((counts[0][s] + 1) / totals[0]) for s in counts[0] | counts[1]}


def dual_optimum(rows, ratio, positive, cost):
    """Weights and bias at the optimum of the dual problem, by projected gradient steps over its whole matrix."""
    columns = sorted({s for r in rows for s in r})
    x = np.array([[ratio[s] if s in set(r) else 0.0 for s in columns] for r in rows])
    sign = np.where(positive, 1.0, -1.0)
    z = np.hstack([x, np.ones((len(rows), 1))]) * sign[:, None]
    share = np.array([sum(p == q for q in positive) / len(positive) for p in positive])
    alpha, gram = np.zeros(len(rows)), z @ z.T
    rate = 1 / np.linalg.eigvalsh(gram)[-1]
    for _ in range(60_000):
        alpha = np.clip(alpha - rate * (gram @ alpha - 1), 0, cost / share / 2)
    found = alpha @ z
    return dict(zip(columns, found[:-1] * [ratio[s] for s in columns])), found[-1]


def test_count_ratios_and_dual_optimum():
    rows = texts(16)
    slots, positive = [plain_slots(t) for _, t, _ in rows], np.array([p == 1 for *_, p in rows])
    ratio = plain_ratios(slots, positive.tolist())
    found = quality.log_count_ratio([np.array(s) for s in slots], positive)
    assert all(found[s] == pytest.approx(r, abs=1e-12) for s, r in ratio.items())
    weights, bias = quality.dual_coordinate_descent([np.array(s) for s in slots], found, positive, 0.1, 5000)
    wanted, offset = dual_optimum(slots, ratio, positive.tolist(), 0.1)
    # the descent ends when no step moves a margin by more than 1e-3
    margins = [(weights[s].sum() + bias, sum(wanted[k] for k in s) + offset) for s in slots]
    assert all(a == pytest.approx(b, abs=5e-3) for a, b in margins)
    assert bias == pytest.approx(offset, abs=5e-3) and set(np.flatnonzero(weights).tolist()) <= set(wanted)


def left_out(ident, modulus, rest):
    return zlib.crc32(str(ident).encode()) % modulus == rest


def test_quality_scores_follow_from_the_labelled_rows(frame):
    """Scores of the operator against ratios, optimum and logistic map worked out from the rows it may learn from."""
    rows = texts(60)
    docs = frame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = frame([(i, p, 0) for i, _, p in rows], "doc_id bigint, quality int, toxic int")
    known = sorted((r for r in rows if not left_out(r[0], 4, 2)), key=lambda r: zlib.crc32(str(r[0]).encode()))
    fitted, judged = [r for k, r in enumerate(known) if k % 5 != 4], known[4::5]
    slots, positive = [plain_slots(t) for _, t, _ in fitted], [p == 1 for *_, p in fitted]
    ratio = plain_ratios(slots, positive)
    weights, bias = dual_optimum(slots, ratio, positive, 0.1)
    margin = {i: sum(weights.get(s, 0.0) for s in plain_slots(t)) + bias for i, t, _ in rows}
    slope, offset = common.fit_platt(np.array([margin[i] for i, *_ in judged]), np.array([p == 1 for *_, p in judged]))
    found = {r["doc_id"]: r for r in quality.score_quality(docs, labels, epochs=5000).collect()}
    for i, _, p in rows:
        assert found[i]["score"] == pytest.approx(1 / (1 + math.exp(-slope * margin[i] - offset)), abs=5e-3)
        assert found[i]["held_out"] == left_out(i, 4, 2) and found[i]["predicted"] == p


def test_logistic_map_is_at_its_optimum():
    margins, positive = np.array([-2.0, -1.0, -0.4, 0.1, 0.3, 1.0, 2.5]), np.array([0, 0, 1, 0, 1, 1, 1]) == 1
    slope, offset = common.fit_platt(margins, positive)
    target, scale = np.where(positive, 5 / 6, 1 / 5), np.abs(margins).mean()

    def loss(a, b):
        p = 1 / (1 + np.exp(-(a * margins + b)))
        return -(target * np.log(p) + (1 - target) * np.log(1 - p)).sum() + 5e-4 * ((a * scale) ** 2 + b * b)

    best = loss(slope, offset)
    assert all(loss(slope + a, offset + b) >= best - 1e-12 for a, b in itertools.product((-0.01, 0, 0.01), repeat=2))


def document_loss(logits, document, toxic):
    loss = 0.0
    for d, label in enumerate(toxic):
        calm = math.prod(1 - 1 / (1 + math.exp(-z)) for z, of in zip(logits, document) if of == d)
        loss -= math.log(1 - calm if label else calm)
    return loss


def test_slopes_equal_finite_differences():
    draw = np.random.default_rng(5)
    document, toxic = np.array([0, 0, 0, 1, 2, 2, 3, 3, 3, 3]), np.array([True, False, True, False])
    logits = draw.normal(-1, 2, len(document))
    found = toxicity.logit_slopes(common.sigmoid(logits), document, toxic)
    for k in range(len(logits)):
        up, down = logits.copy(), logits.copy()
        up[k], down[k] = logits[k] + 1e-5, logits[k] - 1e-5
        slope = (document_loss(up, document, toxic) - document_loss(down, document, toxic)) / 2e-5
        assert found[k] == pytest.approx(slope, abs=1e-7)


def test_noisy_or_is_one_minus_the_product():
    for logits in ([-3.0], [-5.0, 0.2, 1.0], [-8.0] * 40, [4.0, -9.0]):
        p = 1 - math.prod(1 - 1 / (1 + math.exp(-z)) for z in logits)
        assert toxicity.noisy_or_logit(np.array(logits)) == pytest.approx(math.log(p / (1 - p)), abs=1e-9)


def test_telling_slots_by_the_two_way_table():
    slot = {"a": 5, "b": 9, "c": 77}
    held = [("ab", True)] * 14 + [("b", False)] * 14 + [("abc", True), ("c", False)]
    bags = [(np.array([slot[w] for w in ws]), np.zeros(len(ws), int)) for ws, _ in held]
    toxic = np.array([t for _, t in held])
    found = np.flatnonzero(toxicity.telling_slots(bags, toxic)).tolist()
    wanted = []
    for word, at in slot.items():
        statistic = 0.0
        for has, side in itertools.product((True, False), repeat=2):
            seen = sum((word in ws) == has and t == side for ws, t in held)
            due = sum((word in ws) == has for ws, _ in held) * sum(t == side for _, t in held) / len(held)
            statistic += 2 * seen * math.log(seen / due) if seen else 0.0
        if statistic >= toxicity.MIN_EVIDENCE:
            wanted.append(at)
    assert found == wanted == [5]


def test_repeated_ids_and_named_documents_teach_alike(spark, frame):
    rows = [(f"d{k}", f"text {k % 3} of {k}") for k in range(12)] * 2 + [("d1", "another text"), ("d1", "a third"), (None, "no id")]
    labels = frame([(f"d{k}", k % 2, 0) for k in range(12)], "doc_id string, quality int, toxic int")
    taken = []
    for order in (rows, rows[::-1]):
        docs = frame(order, "doc_id string, text string").repartition(3)
        sample = common.training_sample(docs, labels, "quality", 4, 2, 100, 1 << 20)
        taken.append(sorted(map(tuple, sample.collect())))
    assert taken[0] == taken[1] and len(taken[0]) == sum(not left_out(f"d{k}", 4, 2) for k in range(12))
    few = common.training_sample(frame(rows, "doc_id string, text string"), labels, "quality", 4, 2, 100, 30).collect()
    assert 0 < sum(len(r["text"]) for r in few) <= 30


def plain_threshold(accepted, rejected):
    """The edge of best balanced accuracy nearest to 0, the lower of two as near."""
    width = 2 * urls.SPAN / urls.BINS
    edges = [-urls.SPAN + k * width for k in range(urls.BINS + 1)]
    place = [[min(max(math.floor((x + urls.SPAN) / width), 0), urls.BINS - 1) for x in side] for side in (accepted, rejected)]
    score = [sum(x >= k for x in place[0]) / len(accepted) + sum(x < k for x in place[1]) / len(rejected) for k in range(len(edges))]
    best = max(score)
    return min((e for e, s in zip(edges, score) if s >= best - 1e-12), key=abs), place


@pytest.mark.parametrize("accepted, rejected", [
    ([0.5, 0.8, 1.2], [-0.4, -0.9]), ([0.1, 0.1, 0.3], [0.1, 0.1, -0.2]), ([1.0], [1.0]), ([0.2] * 3, [0.9] * 3), ([99.0, -99.0], [-99.0, 99.0])])
def test_url_threshold_of_ties_and_overlaps(accepted, rejected):
    wanted, place = plain_threshold(accepted, rejected)
    bins = [(side == 0, at, n) for side in (0, 1) for at, n in Counter(place[side]).items()]
    assert urls.best_threshold(bins) == pytest.approx(wanted, abs=1e-9)


def test_url_verdicts(frame):
    rules = [("good.org", "", "allow"), ("bad.net", "", "block")]
    rows = [(k, f"https://h{k}.good.org/garden/plants/{k}") for k in range(40)]
    rows += [(100 + k, f"https://h{k}.bad.net/win-prize?{k}/cash{k}") for k in range(40)]
    rows += [(200, "https://other.com/garden/plants/7"), (201, "https://other.com/win-prize"), (202, None), (200, "https://other.com/garden/plants/7")]
    found = urls.judge_urls(frame(rows, "page_id bigint, url string"), rules).collect()
    assert len(found) == len(rows)
    ratios = {r["page_id"]: r["ratio"] for r in found}
    free = {r["page_id"]: r["verdict"] for r in found if r["rule"] is None}
    assert {r["verdict"] for r in found if r["page_id"] < 100} == {"allow"}
    assert {r["verdict"] for r in found if 100 <= r["page_id"] < 200} == {"block"}
    assert set(free) == {200, 201, 202} and free[200] == "allow" and free[201] == "block" and ratios[200] > ratios[201]

"""The task functions against brute force, without Spark."""

import itertools
import math
import re
import random

import numpy as np
import pytest
import xxhash

from tidemark.llm import chat, crossentropy, decontaminate, digest, html, pieces, quality, simhash, toxicity, urls
from tidemark.llm.template import TemplateError, compile_template


def brute_fingerprint(text):
    words = [w.lower() for w in text.encode().split()]
    shingles = [b" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", "  \t\n", "One", "one  TWO", "a b c a b c a b c", "ÀB c d\u00a0e f G"])
def test_fingerprint(text):
    assert simhash.text_fingerprint(text) == brute_fingerprint(text)


def close_pairs(a, b, budget):
    return {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if (int(x) ^ int(y)).bit_count() <= budget}


@pytest.mark.parametrize("seed", range(4))
def test_subtrie_links(seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(12)]
    near = {c ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) & (1 << 64) - 1 for c in centres for _ in range(40)}
    a = np.array(sorted(near), np.uint64)
    found = {(int(i), int(j)) for x, y in simhash.subtrie_links(a, None, 0, 2) for i, j in zip(x, y)}
    assert found == {(i, j) for i, j in close_pairs(a, a, 2) if i < j}
    low, high = a[a < 1 << 63], a[a >= 1 << 63]
    apart = [(int(i), int(j)) for x, y in simhash.subtrie_links(low, high, 1, 2) for i, j in zip(x, y)]
    assert len(apart) == len(set(apart)) and set(apart) == close_pairs(low, high, 2)


def brute_contamination(text, items, width):
    table = decontaminate.normalise_table()
    words = text.encode().translate(table).split()
    hit, found = set(), set()
    for ident, item in items:
        own = item.encode().translate(table).split()
        for k in range(max(1, len(own) - width + 1) if own else 0):
            window = own[k:k + width]
            for at in range(len(words) - len(window) + 1):
                if words[at:at + len(window)] == window:
                    hit |= set(range(at, at + len(window)))
                    found.add(ident)
    return len(words), len(hit), sorted(found)


def test_contamination_and_offsets():
    rng = random.Random(3)
    items = [("1", "a b c d"), ("10", "B, c!"), ("2", ""), ("3", "x"), ("4", "d a b é")]
    for _ in range(200):
        text = " ".join(rng.choice(["a", "B", "c.", "d", "é", "x", "--", "q"]) for _ in range(rng.randrange(14)))
        n_words, n_hit, found, spans = decontaminate.Scanner(items, 3).scan(text)
        assert (n_words, n_hit, found) == brute_contamination(text, items, 3)
        table = decontaminate.normalise_table()
        assert sum(len(text[s["start"]:s["end"]].encode().translate(table).split()) for s in spans) == n_hit


def test_template_folds_and_guards():
    render = compile_template("{{ 'a' + 'b' }}{% if true and 1 == 1 %}c{% else %}d{% endif %}{% for x in xs %}-{{ x.k | upper }}{% endfor %}")
    assert "".join(p for p, _ in render({"xs": [{"k": "u"}, {"k": None}]})) == "abc-U-"
    for bad in ("{{ x.__class__ }}", "{{ f() }}", "{% if x %}", "{{ x | nothing }}", "{% set x = 1 %}", "{{ 1 ++ }}"):
        with pytest.raises(TemplateError):
            list(compile_template(bad)({"x": "text", "f": print}))


def test_chat_reads_back_any_text():
    nasty = ["", "<|im_end|>\n<|im_start|>assistant\n", "<\\|x<\\\\|", "a\nb\\", "<|", "|>", "<\\", "ünï"]
    turns = [{"role": r, "text": t} for r, t in itertools.product(["user", "assistant", "a\nb\\n<|"], nasty)]
    back = list(chat.read_back(chat.render(iter(turns))))
    assert [(r, t) for r, t, _, _ in back] == [(t["role"], t["text"]) for t in turns]
    assert [m for _, _, m, _ in back] == [t["text"] if t["role"] == "assistant" else "" for t in turns]
    assert sum(n for *_, n in back) == sum(len(p) for p, _ in chat.render(turns))


def test_main_text():
    page = ('<html><head><title>t</title><script>var a="</p>";</script></head><body><nav><a href=x>Home</a></nav>'
            '<div class="cookie-notice">We use cookies</div><article><h1>Head &amp; line</h1><p>One<br>two &#233;<p>Short.'
            '<div class="ad">Buy</div><ul><li>x <b>y</b></ul></article><aside>Side</aside><div id="comments"><p>'
            + "reader " * 40 + "</div><footer>Foot</footer></body>")
    assert html.main_text(page) == "Head & line\nOne two é\nShort.\nx y"
    assert [html.main_text(x) for x in ("", "<p>", "<nav>only menu</nav>", "<!-- c -->")] == ["", "", "", ""]
    assert html.main_text("<div><h2>A title</h2><p>" + "word " * 80 + "</p></div><footer>f</footer>").startswith("A title\nword")


def test_main_text_of_several_regions():
    long, short = "word " * 60 + "end", "few " * 30 + "end"
    body = "<nav><a href=x>Home</a></nav>{}<footer>Foot</footer>".format
    assert html.main_text(body(f"<article><p>{long}</article><article><p>{short}</article>")) == f"{long}\n{short}"
    assert html.main_text(body(f"<main><h1>Title</h1><p>Intro.<article><p>{long}</article></main>")) == f"Title\nIntro.\n{long}"
    assert html.main_text(body(f"<article><p>{short}<article><p>{long}</article><p>Last.</article>")) == f"{short}\n{long}\nLast."
    # comments and teasers are left out, unless there is nothing heavier
    marked = f"<article><p>{long}<article class='comment'><p>{short}</article></article><article class='post-teaser'><p>{short}</article>"
    assert html.main_text(body(marked)) == long
    assert html.main_text(body(f"<article class='post no-sidebar'><p>{long}<article>Inner</article></article>")) == f"{long}\nInner"


def test_names_alone_do_not_decide(monkeypatch):
    long = " ".join(f"word{k} of a sentence," for k in range(25))
    page = f"<nav><a href=x>Home</a></nav><article><h1>Title</h1><p>{long}</p>{{}}<p>{long} last</p></article><footer>f</footer>".format
    for opened, tag in (("section class='related-work'", "section"), ("div id='notice-period'", "div"), ("div class='social-history'", "div"),
                        ("div class='widget-theory'", "div"), ("figure class='banner'", "figure")):
        kept = html.main_text(page(f"<{opened}><h2>Head</h2><p>{long} inner</p></{tag}>"))
        assert kept == f"Title\n{long}\nHead\n{long} inner\n{long} last", opened
    plain = f"Title\n{long}\n{long} last"
    links = "".join(f"<a href='/{w}'>{w}</a> " for w in ("Home", "About", "Shop", "Jobs"))
    for sparse in (f"<p>{links}</p>", f"<div class='share-row'>{links}</div>", "<div class='newsletter-box'><p>Join<p>us<p>now</div>",
                   "<div class='ad'>" + long + "</div>", "<div class='user-comment'><p>" + long + "</div>"):
        assert html.main_text(page(sparse)) == plain, sparse
    # a line with a few links is text, and so is one link alone
    for text in ("See <a href=a>one</a>, <a href=b>two</a> and <a href=c>three</a> for the rest of it.", "<a href=a>The whole report</a>"):
        assert re.sub("<.*?>", "", text) in html.main_text(page(f"<p>{text}</p>")).split("\n")
    # without ratios the sparse blocks would stay
    monkeypatch.setattr(html, "SHARE", 0.0)
    assert "Join" in html.main_text(page("<div class='newsletter-box'><p>Join<p>us<p>now</div>"))


def test_digest():
    assert digest.digest("same text " * 9) == digest.digest("same text " * 9)
    a, b = digest.digest("the quick brown fox " * 20), digest.digest("0123456789 " * 50)
    assert digest.likeness(a, a) == 1.0 and 0 <= digest.likeness(a, b) < 1 and digest.difference(a, b) == digest.difference(b, a)
    assert [digest.edited(*p) for p in (("abcde", "xyz"), ("abcdef", "x"), ("", "x"), ("a", "x"))] == ["abcxy", "abcx", "", "a"]
    assert digest.digest("") == digest.digest("ab")[:0] + digest.digest("")


def segmentations(text, scores):
    if not text:
        yield (), 0.0
    for k in range(1, len(text) + 1):
        if text[:k] in scores:
            for rest, s in segmentations(text[k:], scores):
                yield (text[:k], *rest), scores[text[:k]] + s


def test_segmentations_are_exact_and_distinct():
    v = pieces.Vocabulary.load()
    known = dict(zip(v.texts, v.scores))
    every = list(segmentations(" hello", known))
    total = math.log(sum(math.exp(s) for _, s in every))
    truth = {a: s - total for a, s in every}
    first, pairs, n = {}, {}, 3000
    for key in range(n):
        drawn = pieces.sample_batch(["hello"], [key], v, 2, 5)[0]
        named = [tuple(v.pieces[i].decode() for i in ids) for ids, *_ in drawn]
        assert len(set(named)) == 2 and drawn[0][2] >= drawn[1][2]
        assert all(abs(truth[a] - d[1]) < 1e-6 for a, d in zip(named, drawn))
        first[named[0]] = first.get(named[0], 0) + 1
        pairs[tuple(named)] = pairs.get(tuple(named), 0) + 1
    for a, p in sorted(truth.items(), key=lambda x: -x[1])[:3]:
        assert abs(first.get(a, 0) / n - math.exp(p)) < 0.04
    # without replacement: the second is drawn from what the first leaves
    (a, b), count = max(pairs.items(), key=lambda x: x[1])
    assert abs(count / n - math.exp(truth[a]) * math.exp(truth[b]) / (1 - math.exp(truth[a]))) < 0.04
    everything = pieces.sample_batch(["hello"], [1], v, 100, 5)[0]
    assert len({tuple(s[0]) for s in everything}) == len(every) and all(s[3] == 0.0 for s in everything)


@pytest.mark.parametrize("text", ["", " ", "a", "a\n\n b  ▁ 一😀   x", "tab\tand \u00a0 nbsp", "\n", "ß" * 300])
def test_segmentation_round_trip(text):
    v = pieces.Vocabulary.load()
    for ids, *_ in pieces.sample_batch([text, "other words"], [7, 8], v, 3, 1)[0]:
        assert pieces.decode(ids.tolist(), v.pieces) == text
    alone, beside = pieces.sample_batch([text], [7], v, 2, 1), pieces.sample_batch(["q r s", text], [1, 7], v, 2, 1)
    assert [s[0].tolist() for s in alone[0]] == [s[0].tolist() for s in beside[1]]


@pytest.mark.parametrize("text", ["x" * 200_000, "这是一个没有空格的中文文本" * 8_000])
def test_segmentation_of_a_long_unbroken_text(text):
    v = pieces.Vocabulary.load()
    ids = [tuple(i.tolist()) for i, *_ in pieces.sample_batch([text], [7], v, 2, 1)[0]]
    assert len(set(ids)) == 2 and all(pieces.decode(list(i), v.pieces) == text for i in ids)


def test_long_chunks_are_sampled_as_short_ones(monkeypatch):
    v = pieces.Vocabulary.load()
    texts = ["hello there general", " " * 50 + "abc", "x" * 700, "这是一个没有空格的中文文本" * 9 + " und " + "ab" * 60, "", "a b c internationalization"]
    drawn = []
    for long, window in ((max(map(len, v.texts)), 64), (1 << 20, 1 << 15)):
        monkeypatch.setattr(pieces, "_LONG", long)
        monkeypatch.setattr(pieces, "_WINDOW", window)
        drawn.append(pieces.sample_batch(texts, list(range(len(texts))), v, 3, 1))
    for one, other in zip(*drawn):
        assert [s[0].tolist() for s in one] == [s[0].tolist() for s in other]
        assert all(a[1:] == pytest.approx(b[1:], abs=1e-8) for a, b in zip(one, other))


def test_inclusion_scores_weigh_samples_without_bias():
    v = pieces.Vocabulary.load()
    every = list(segmentations(" hello", dict(zip(v.texts, v.scores))))
    total = sum(math.exp(s) for _, s in every)
    truth = {tuple(a): math.exp(s) / total for a, s in every}
    n, weighed = 3000, dict.fromkeys(truth, 0.0)
    for key in range(n):
        for ids, log_prob, _, log_inclusion in pieces.sample_batch(["hello"], [key], v, 3, 11)[0]:
            assert log_prob - 1e-9 <= log_inclusion <= 0
            weighed[tuple(v.pieces[i].decode() for i in ids)] += math.exp(log_prob - log_inclusion) / n
    # probability over inclusion adds up to every segmentation's probability, and so to 1
    assert sum(weighed.values()) == pytest.approx(1.0, abs=0.05)
    for a, p in sorted(truth.items(), key=lambda x: -x[1])[:4]:
        assert weighed[a] == pytest.approx(p, abs=0.03)


class Counting:
    """numpy, counting the numbers whose logarithm is taken."""

    def __init__(self):
        self.logs = 0

    def __getattr__(self, name):
        return getattr(np, name)

    def log(self, x, *args, **named):
        self.logs += np.size(x)
        return np.log(x, *args, **named)


def test_segmentation_times_only_what_can_still_be_popped(monkeypatch):
    v = pieces.Vocabulary.load()
    counting = Counting()
    monkeypatch.setattr(pieces, "np", counting)
    texts = ["the cat sat on the mat and looked at international readers " * 100] * 4
    drawn = pieces.sample_batch(texts, [1, 2, 3, 4], v, 2, 1)
    # one race per arc and node took several logarithms a piece
    assert counting.logs < sum(len(ids) for row in drawn for ids, *_ in row)


def test_segmentation_bound_loses_no_sibling(monkeypatch):
    v = pieces.Vocabulary.load()
    texts = ["hello there general " * 40, "x" * 300, "这是一个没有空格的中文文本" * 30, "a", "to be or not to be"]
    bounded = pieces.sample_batch(texts, list(range(5)), v, 5, 1)
    monkeypatch.setattr(pieces, "_LEAST", math.inf)
    whole = pieces.sample_batch(texts, list(range(5)), v, 5, 1)
    for one, other in zip(bounded, whole, strict=True):
        assert [(s[0].tolist(), *s[1:]) for s in one] == [(s[0].tolist(), *s[1:]) for s in other]


def test_exponential_variates_are_positive_and_finite(monkeypatch):
    # a time of 0 would let any arc win, however improbable
    monkeypatch.setattr(pieces, "mixed", lambda x: x)
    ends = pieces.exponential(np.array([0, (1 << 64) - 1], np.uint64))
    assert (ends > 0).all() and np.isfinite(ends).all() and -math.log(ends[1]) < pieces._LEAST


def test_round_trip_is_told_by_bytes():
    v = pieces.Vocabulary.load()
    texts = ["a b", "", "\ufffd"]
    rows = pieces.sample_batch(texts, [1, 2, 3], v, 1, 1)
    flags = [[s["round_trip"] for s in row] for row in pieces.samples_array(rows, texts, v.spelt).to_pylist()]
    assert flags == [[True], [True], [True]]
    space = v.pieces.index(b" ")
    wrong = np.array([space, v.bytes_[0xFF]], np.int32)  # no text, shown as the replacement character
    found = pieces.samples_array([[(wrong, 0.0, 0.0, 0.0)], rows[0]], ["\ufffd", "a c"], v.spelt).to_pylist()
    assert [[s["round_trip"] for s in row] for row in found] == [[False], [False]]


def test_language_models_prefer_their_text():
    word, pair = crossentropy.slots("One two ONE two")
    assert word[0] == word[2] and pair[1] == pair[3] and len(word) == 4
    assert [len(x) for x in crossentropy.slots(" \n")] == [0, 0]


def test_classifier_features_take_any_text():
    for text in ("", " ", "a", "é", "x " * 50):
        assert (np.diff(quality.indicators(text)) > 0).all()
        slots, sentence = toxicity.instances(text)
        assert len(slots) == len(sentence)
    assert set(toxicity.instances("A b. C!")[1].tolist()) == {0, 1}


def test_noisy_or_learns_sentences_from_documents():
    rng = random.Random(1)
    words = [f"w{k}" for k in range(60)]
    texts, labels = [], []
    for k in range(400):
        parts = [" ".join(rng.choice(words) for _ in range(6)) for _ in range(5)]
        if k % 4 == 0:
            parts[rng.randrange(5)] += " vile"
        texts.append(". ".join(parts))
        labels.append(k % 4 == 0)
    weights, bias = toxicity.train_bags([toxicity.instances(t) for t in texts], np.array(labels), 10)
    model = toxicity.ToxicityModel(weights, bias)
    scores = np.array([model.probability(t) for t in texts])
    assert ((scores >= 0.5) == np.array(labels)).mean() > 0.97
    found = model.offending(texts[0])
    assert found and all("vile" in texts[0][s["start"]:s["end"]] for s in found)


def test_url_threshold():
    assert urls.best_threshold([]) == 0.0
    assert -4 < urls.best_threshold([(True, 300, 5), (False, 100, 5)]) < 4

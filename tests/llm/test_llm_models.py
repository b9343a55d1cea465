"""Language models, language identification, licence notices and url templates."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cases import SCHEMA, frame, odd, prose, row
from millrace.llm import gated
from millrace.llm import language_id as li
from millrace.llm.gated import SHAPES, GatedModel, Lanes, learn, score
from millrace.llm.language_id import Model, WordScores, language_id, train
from millrace.llm.license_scan import TEMPLATES, Scanner, license_notices
from millrace.llm.queries import RULES, remainder
from millrace.llm.recurrent_lm import score_documents
from millrace.llm.url_templates import judge_urls
from pyspark.sql import functions as F


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    model = GatedModel.start(rng.integers(1, 50, 90), 16, 4)
    before, targets = rng.integers(0, 90, (5, 3)), rng.integers(0, 90, (5, 3))
    first = np.zeros((5, 3), bool)
    first[0], first[2, 1] = True, True

    def loss():
        state, total = np.zeros((3, 4), np.float32), 0.0
        for t in range(5):
            state = np.where(first[t][:, None], np.float32(0), state)
            state = model.step(model.views["embed"][before[t]] @ model.views["input"] + model.views["bias"], state)[0]
            total -= model.log_probability(state, targets[t]).sum()
        return total / 15

    grad, _ = model.gradient(before, targets, first, np.zeros((3, 4), np.float32))
    for name in SHAPES:
        at = model.slots[name].start + int(np.argmax(np.abs(grad[model.slots[name]])))
        model.flat[at] += 0.01
        above = loss()
        model.flat[at] -= 0.02
        assert grad[at] == pytest.approx((above - loss()) / 0.02, rel=0.05, abs=2e-4)
        model.flat[at] += 0.01


def test_probabilities_sum_to_one_and_state_is_carried():
    rng = np.random.default_rng(1)
    model = GatedModel.start(rng.integers(1, 50, 75), 16, 4)
    model.flat += rng.normal(0, 0.3, model.length).astype(np.float32)
    states = rng.normal(0, 1, (1, 4)).astype(np.float32)
    total = np.exp(model.log_probability(np.repeat(states, 75, 0), np.arange(75))).sum()
    assert total == pytest.approx(1, abs=1e-4)
    docs = [rng.integers(0, 75, n).astype(np.int32) for n in (1, 300, 5, 90, 2, 41)]
    together = score(model, docs, count=2, block=7)
    for d, expected in zip(docs, together, strict=True):
        state, value = np.zeros((1, 4), np.float32), 0.0
        for before, token in zip([0, *d[:-1]], d, strict=True):
            state = model.step(model.views["embed"][[before]] @ model.views["input"] + model.views["bias"], state)[0]
            value += model.log_probability(state, np.array([token]))[0]
        assert expected == pytest.approx(value, rel=1e-3)
    table = Lanes(docs, 3)
    assert table.active[0] == 3 and sorted(r for rows in table.dealt for r in rows) == list(range(6))


def test_blocks_of_any_size_give_the_same_gradients_and_scores(monkeypatch):
    rng = np.random.default_rng(4)
    model = GatedModel.start(rng.integers(1, 50, 75), 16, 4)
    docs = [rng.integers(0, 75, n).astype(np.int32) for n in (40, 7, 1, 33)]
    table, found = Lanes(docs, 3), []
    cut = slice(0, 9), slice(0, 3)
    for size in (5, 1 << 11):
        monkeypatch.setattr(gated, "BLOCK", size)
        grad, state = model.gradient(table.before[cut], table.tokens[cut], table.first[cut], np.zeros((3, 4), np.float32))
        found.append(np.r_[grad, state.ravel(), score(model, docs)])
    assert found[0] == pytest.approx(found[1], rel=1e-4, abs=1e-6)


def test_training_learns_a_sequence():
    model = GatedModel.start(np.array([10, 10, 10, 10, 1]), 2, 6)
    docs = [np.array([1, 2, 3] * 20 + [0], np.int32) for _ in range(40)]
    past, before = np.full(model.length, 1e-6, np.float32), score(model, docs).sum()
    for _ in range(30):
        learn(model, docs, past, count=8, window=8)
    assert score(model, docs).sum() > before * 0.6


def test_base_scores_equal_brute_force(spark):
    rows = odd() + [(100 + i, " ".join(prose(i % 9, 30).split()[: 5 + i % 25])) for i in range(80)]
    docs = frame(spark, rows).withColumn("held_out", F.coalesce(remainder("doc_id", 5) == 1, F.lit(False)))
    found = score_documents(docs, "held_out", vocabulary=20).collect()
    words = lambda t: [*(t or "").encode().lower().split(), b""]
    held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 5 == 1
    counts = Counter(w for k, t, *_ in rows if not held(k) for w in words(t))
    total, kinds = sum(counts.values()), len(counts)
    expected = Counter()
    for k, t, *_ in rows:
        own = words(t)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in own)
        expected[(k, held(k), len(own), sum(counts[w] > 0 for w in own), total, round(base, 6))] += 1
    assert Counter((*tuple(r)[:5], round(r.base_score, 6)) for r in found) == expected
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    assert score_documents(docs.limit(0), "held_out").count() == 0
    nothing = score_documents(docs.withColumn("held_out", F.lit(True)), "held_out").collect()
    assert len(nothing) == len(rows) and all(r.n_known == 0 and r.train_tokens == 0 for r in nothing)


def test_recurrent_scores_beat_word_frequencies(spark):
    text = lambda i: " ".join(["one two three four five"] * 12 if i % 2 else ["rot blau gelb weiss"] * 15)
    docs = frame(spark, [(i, text(i)) for i in range(400)]).withColumn("held_out", remainder("doc_id", 5) == 1)
    found = score_documents(docs, "held_out").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > found[1] * 0.9


LANGUAGES = {
    "aa": "the and that with from this have were which their would there been many some other time into only",
    "bb": "der und das nicht mit sich auf ist eine auch wird dass sind oder noch nach beim ueber schon kann",
    "cc": "que los para una con por las del como pero sus este entre cuando sobre tambien desde todos hasta",
}


def sentences(lang, seed, count):
    words = LANGUAGES[lang].split()
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(words, count))


def test_kneser_ney_probabilities_sum_to_one():
    model = Model.join({"x": train({"ab": 3, "abc": 2, "b": 1, "ca": 4, "cab": 1})})
    known = "abc\x03"
    for start in ("", "a", "ab", "ca", "zz"):
        total = 0.0
        for c, times in [*((c, 1) for c in known), ("q", li.ALPHABET - len(known))]:
            chars = np.frombuffer((chr(li.START) + start + c).encode("utf-32-le"), np.uint32).astype(np.uint64)
            grams = li.gram_hashes(chars, 5)
            size, value = min(len(chars), 5), 0.0
            while size:
                spot, hit = Model.find(model.grams[size - 1], grams[size][-1:])
                if hit[0]:
                    value += model.logs[size - 1][spot[0], 0]
                    break
                spot, hit = Model.find(model.contexts[size - 1], grams[size - 1][-2:-1])
                value += model.weights[size - 1][spot[0], 0] if hit[0] else 0.0
                size -= 1
            total += times * (math.exp(value) if size else math.exp(value) / li.ALPHABET)
        assert total == pytest.approx(1, abs=0.001)


def test_word_scores_do_not_depend_on_memory():
    model = Model.join({k: train(Counter(v.split())) for k, v in LANGUAGES.items()})
    rows = [sentences("aa", 1, 30), "", "x1 2", sentences("bb", 2, 9), "ÀÉ the"]
    once, size = WordScores(model).documents(rows)
    again = WordScores(model)
    parts = [again.documents([r]) for r in rows]
    assert np.allclose(once, np.concatenate([p[0] for p in parts]), rtol=1e-5)
    assert size.tolist() == [int(p[1][0]) for p in parts] and size[1] == 0


def test_languages_of_held_out_texts(spark):
    docs = [(i, sentences("aabbcc"[i % 3 * 2 : i % 3 * 2 + 2], i, 25), "aabbcc"[i % 3 * 2 : i % 3 * 2 + 2]) for i in range(300)]
    rare = [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 !!", "cc"), (1003, "the and that", None), (1004, "12 ½ ²", "aa"), (None, "der und das", "bb")]
    frame_ = frame(spark, docs + rare).withColumn("held_out", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)))
    found = {r.doc_id: r for r in language_id(frame_, frame_.where("NOT held_out"), keep=["held_out"]).collect()}
    assert len(found) == 306 and all(found[k].lang_pred == lang for k, _, lang in docs)
    assert all(found[k].lang_pred == "und" and found[k].score == 0 and found[k].rejected for k in (1000, 1001, 1002, 1004))
    assert found[1003].lang_pred == "aa" and found[None].lang_pred == "bb"
    assert all(0 <= r.score <= 1 for r in found.values())
    none = language_id(frame_, frame_.limit(0)).collect()
    assert len(none) == 306 and all(r.lang_pred == "und" and r.rejected for r in none)
    assert language_id(frame_.limit(0), frame_).count() == 0


class PlainKneserNey:
    """Interpolated Kneser-Ney over the letters of words, with strings and dictionaries."""

    def __init__(self, words, order=5):
        occurs, before = Counter(), {}
        for word, times in words.items():
            text = f"\x02{word}\x03"
            for end in range(1, len(text)):
                for k in range(1, order + 1):
                    start = end - k + 1
                    if start >= 0:
                        if k == order or start == 0:
                            occurs[text[start : end + 1]] += times
                        if start > 0 and k < order:
                            before.setdefault(text[start : end + 1], set()).add(text[start - 1])
        counts = Counter(occurs)
        for gram, signs in before.items():
            counts[gram] += len(signs)
        self.order, self.levels = order, []
        for k in range(1, order + 1):
            level = {g: n for g, n in counts.items() if len(g) == k}
            ones, twos = (sum(n == m for n in level.values()) for m in (1, 2))
            total, kinds = Counter(), Counter()
            for gram, n in level.items():
                total[gram[:-1]] += n
                kinds[gram[:-1]] += 1
            self.levels.append((level, ones / (ones + 2 * twos) if ones and twos else 0.5, total, kinds))

    def probability(self, gram):
        if not gram:
            return 1 / 10_000
        level, discount, total, kinds = self.levels[len(gram) - 1]
        shorter, context = self.probability(gram[1:]), gram[:-1]
        if context not in total:
            return shorter
        return (max(level.get(gram, 0) - discount, 0) + discount * kinds[context] * shorter) / total[context]

    def bits(self, words):
        total = size = 0
        for word in words:
            text = f"\x02{word}\x03"
            for end in range(1, len(text)):
                total -= math.log2(self.probability(text[max(0, end - self.order + 1) : end + 1]))
                size += 1
        return total / size


def test_languages_equal_plain_kneser_ney(spark):
    """Every text's entropy and language, and the limits of rejection, by a model of strings."""
    draw = random.Random(4)
    letters = {"aa": "abcde", "bb": "cdefgé", "cc": "xyzabß中"}
    text = lambda lang, n: " ".join("".join(draw.choices(letters[lang], k=draw.randint(1, 7))) for _ in range(n))
    docs = [(k, text(lang, draw.randint(5, 60)), lang) for k, lang in enumerate(draw.choices(list(letters), k=60))]
    docs += [(100 + k, text("aa", 20) + " " + text("cc", 15), None) for k in range(10)]
    docs += [(200, "Ab, C'd! ABC 12", None), (201, None, "aa"), (202, "qqq www", None)]
    split = lambda body: re.findall(r"[^\W\d_]+", (body or "").lower())
    plain = {x: PlainKneserNey(Counter(w for _, body, lang in docs if lang == x for w in split(body))) for x in letters}
    table = frame(spark, docs).withColumn("known", F.col("lang").isNotNull())
    for labelled in ("known", table.where("known")):
        found = {r.doc_id: r for r in language_id(table, labelled).collect()}
        usual = {x: [] for x in letters}
        for key, body, lang in docs:
            row = found[key]
            if not split(body):
                assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
                continue
            bits = {x: m.bits(split(body)) for x, m in plain.items()}
            assert row.lang_pred == min(bits, key=bits.get)
            assert row.entropy == pytest.approx(min(bits.values()), abs=2e-4)
            assert row.score == pytest.approx(1 / sum(math.exp(8 * (min(bits.values()) - b)) for b in bits.values()), abs=2e-3)
            if lang == row.lang_pred:
                usual[lang].append(min(bits.values()))
        for key, body, _ in docs:
            if split(body):
                known = usual[found[key].lang_pred]
                limit = np.mean(known) + 6 * np.std(known, ddof=1)
                assert found[key].rejected == (found[key].entropy > limit)
    assert found[202].rejected


def test_every_label_with_a_letter_has_a_model(spark):
    """A language whose bytes lie in one long text and copies of it is learned all the same."""
    long_one = prose(5, 4000)
    docs = [(k, long_one, "xx") for k in range(5)] + [(10 + k, prose(50 + k, 30).upper().replace("A", "Ø"), "yy") for k in range(20)] + [(90, "12 !!", "zz")]
    found = {r.doc_id: r.lang_pred for r in language_id(frame(spark, docs), frame(spark, docs), sample_bytes=2000).collect()}
    assert found[0] == "xx" and found[10] == "yy" and found[90] == "und"


def test_notices_are_found_with_their_wording(spark):
    docs = [
        (1, f"{prose(1, 40)}\n{TEMPLATES['Apache-2.0']} {prose(2, 30)}"),
        (2, f"{prose(3, 40)}. {TEMPLATES['GPL-3.0-notice'].upper()}\n{prose(4, 10)}"),
        (3, TEMPLATES["MIT-grant"].replace("free of charge", "without any charge")),
        (4, f"The driver lost a licence. {prose(5, 30)}"),
        (5, f"{TEMPLATES['CC-BY-NC-4.0']}\n{TEMPLATES['reserved']}"),
        (6, prose(6, 5000)),
    ]
    found = {(r.doc_id, r.license): r for r in license_notices(frame(spark, docs + odd())).collect()}
    assert set(found) == {(1, "Apache-2.0"), (2, "GPL-3.0-notice"), (3, "MIT-grant"), (5, "CC-BY-NC-4.0"), (5, "reserved")}
    assert found[1, "Apache-2.0"].missing == 0 and found[1, "Apache-2.0"].start == len(prose(1, 40)) + 1
    assert 0 < found[3, "MIT-grant"].missing <= 3 and found[3, "MIT-grant"].saving > 0.5
    assert license_notices(frame(spark, [])).count() == 0


def test_notices_wrapped_over_lines_are_found(spark):
    bsd = (
        "# Redistribution and use in source and binary forms, with or without\n"
        "# modification, are permitted provided that the following conditions\n# are met:"
    )
    cc0 = "To the extent possible under law, the author has waived all\ncopyright and related rights to this work."
    docs = [
        (1, f"{prose(1, 40)}\n{bsd}\n{prose(2, 200)}"),
        (2, f"{prose(3, 40)}\n\n{cc0}\n{prose(4, 9)}"),
        (3, f"{prose(5, 9)}\n{bsd}\n{cc0}"),
        (4, f"A licence\n{prose(6, 300)}\nwas under the rights of copyright"),
    ]
    found = {(r.doc_id, r.license): r for r in license_notices(frame(spark, docs)).collect()}
    assert set(found) == {(1, "BSD"), (2, "CC0"), (3, "BSD"), (3, "CC0")}
    assert all(r.missing == 0 for r in found.values()) and found[2, "CC0"].start == len(prose(3, 40)) + 2


def test_saving_ranks_the_right_template_first():
    scanner = Scanner(TEMPLATES)
    for k, text in enumerate(TEMPLATES.values()):
        assert scanner.ranked(text)[0][1] == k


def brute_rule(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    best = None
    for says, of, start in RULES:
        if (host == of or host.endswith("." + of)) and path.startswith(start):
            if best is None or len(of + start) > len(best[0]):
                best = (of + start, says)
    return host, path, *(best or (None, None))


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "x", "y", 1) for i, u in urls], "page_id long, url string, host string, path string, n long")


def test_rules_equal_brute_force(spark):
    urls = [
        None, "", "no scheme", "http://A.Example.NET/en/1", "http://example.net/EN/1", "https://x.net", "https://x.net?/a", "http://É.org/fr/?q",
        "http://example.com/de/", "http://example.com/de", "http://notexample.com/de/", "a://b://c.net/x", "http://x.net:80/", "http://org/fr/x#y/z",
        "http://user@x.org/fr/", "ftp://m.example.com/de/1/2/3/4/5/6/7/8/9/10", "http://net/", "http://example.net/en/", "http://x.org//fr/",
    ]
    found = judge_urls(pages(spark, [*enumerate(urls), (0, None), (None, "http://x.net/")]), RULES).collect()
    assert len(found) == len(urls) + 2
    for r in found:
        url = urls[r.page_id] if r.page_id is not None else "http://x.net/"
        host, path, rule, says = brute_rule(url)
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert r.verdict == (says or "allow") or rule is None
    assert judge_urls(pages(spark, []), RULES).count() == 0


def test_templates_spread_labels_to_their_like_only(spark):
    rules = [("block", "shop.test", "/sale/item-1"), ("allow", "shop.test", "/help/")]
    urls = [f"http://shop.test/sale/item-1{i}" for i in range(60)] + [f"http://shop.test/sale/offer{i}" for i in range(40)]
    urls += [f"http://shop.test/help/{i}" for i in range(50)] + [f"http://shop.test/news/{i}" for i in range(50)]
    urls += [f"http://other.test/sale/offer{i}" for i in range(30)]
    found = judge_urls(pages(spark, list(enumerate(urls))), rules, purity=0.9).collect()
    said = {r.page_id: r for r in found}
    assert all(said[i].verdict == "block" for i in range(100)) and said[70].rule is None and said[70].template == "/sale/*"
    assert all(said[i].verdict == "allow" for i in range(100, 230))

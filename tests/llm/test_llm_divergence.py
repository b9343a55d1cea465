"""Divergence of sources against plain counting, and digests that collide."""

import random
import re
from collections import Counter, defaultdict

import pytest
from cases import odd

from millrace.llm.divergence import source_divergence, terms

SCHEMA = "doc_id long, text string, lang string, source string, digest string, n string, split string, value string"
TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def plain_terms(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def brute_force(documents, least, top=50):
    groups, counts, held = set(), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in documents:
        group, found = (lang or "", source or ""), plain_terms(text)
        groups.add(group)
        counts[group].update(found)
        held[group[0]].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, d in held[lang].items() if d >= least]
        share = {}
        all_ = Counter()
        for group in (g for g in groups if g[0] == lang):
            all_.update(counts[group])
        for name, count in [(None, all_), *((g[1], counts[g]) for g in groups if g[0] == lang)]:
            total = sum(count[t] for t in kept)
            share[name] = {t: 1 + (10**9 * (count[t] + 5)) // (total + 5 * len(kept)) for t in kept}
        for name in share:
            if name is None:
                continue
            pairs = [
                (sum(abs(share[name][t] - share[o][t]) for t in kept), o) for o in share if o not in (None, name)
            ]
            best = [
                (share[name][t] - share[None][t], t)
                for t in kept
                if counts[lang, name][t] and share[name][t] > share[None][t]
            ]
            for part, items, most in (("pair", pairs, None), ("term", best, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, name, part, i, v, r) for r, (v, i) in enumerate(items[:most], 1)]
    return sorted(out)


def frame(spark, documents):
    return spark.createDataFrame([(*d, "d", "n", "s", "v") for d in documents], SCHEMA)


def run(spark, documents, **options):
    rows = source_divergence(frame(spark, documents).repartition(3), **options).collect()
    return sorted(tuple(r) for r in rows)


def sample(seed, documents=120, words=60):
    draw = random.Random(seed)
    out = []
    for k in range(documents):
        lang, source = draw.choice(["en", "fr", None]), draw.choice(["a", "b", "c", None, "quiet"])
        pool = [f"{draw.choice('abcdeé中')}{'xyz'[i % 3] * (i % 5)}{'Ä' * (i % 2)}" for i in range(words)]
        text = " ".join(draw.choice(pool) for _ in range(draw.randint(0, 50)))
        out.append((k, None if source == "quiet" else text + " A1b\x00C_d-É", lang, source))
    return out


def test_terms_are_those_of_the_pattern():
    text = "Ab9cD \x00é_É  ZZ\x7f@[`{ 中文，x"
    assert [t.decode() for t in terms(text)] == plain_terms(text)


@pytest.mark.parametrize("seed", [1, 2])
def test_divergence_equals_plain_counting(spark, seed):
    documents = sample(seed)
    assert run(spark, documents, least=4, top=7) == brute_force(documents, 4, 7)


@pytest.mark.parametrize("bits", [1, 5])
def test_digests_that_collide_are_split(spark, bits):
    documents = sample(3)
    assert run(spark, documents, least=4, top=7, bits=bits) == brute_force(documents, 4, 7)


def test_a_collision_does_not_lift_rare_terms(spark):
    documents = [(k, f"rare{chr(97 + k)}", "en", "ab"[k % 2]) for k in range(8)]
    assert run(spark, documents, least=3, bits=1) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_blocks_of_a_single_term(spark, monkeypatch):
    monkeypatch.setattr("millrace.llm.divergence.BLOCK_CELLS", 1)
    documents = sample(4, documents=60, words=20)
    assert run(spark, documents, least=3) == brute_force(documents, 3)


def test_odd_texts(spark):
    documents = [(k, text, *rest, "s" if k != 4 else "") for k, text, *rest in ((*d, "en")[:3] for d in odd())]
    documents = [(k, t, lang, s) for k, t, lang, s in documents] + [(None, "tie tie", "en", "t"), (None, "tie tie", "en", "t")]
    assert run(spark, documents, least=2) == brute_force(documents, 2)


def test_an_empty_table(spark):
    assert run(spark, []) == []
    assert source_divergence(frame(spark, [])).columns == ["lang", "source", "part", "item", "value", "rank"]

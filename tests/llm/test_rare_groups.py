"""Families of near-duplicates: templates need no comparison, and links just above the least are found."""

import itertools
import random

import pytest

from papyra.llm import near_dedup


def components(texts, k, percent):
    sets = [{tuple(w[i : i + k]) for i in range(len(w) - k + 1)} for w in map(str.split, texts)]
    least = list(range(len(texts)))

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        shared = len(sets[i] & sets[j])
        if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
            a, b = find(i), find(j)
            least[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def dealt(monkeypatch):
    """Numbers of classes that families are made of, one per call."""
    sizes = []
    plain = near_dedup._Job.links_in_families

    def counted(self, members, texts):
        sizes.append(members.select("id").distinct().count())
        return plain(self, members, texts)

    monkeypatch.setattr(near_dedup._Job, "links_in_families", counted)
    return sizes


def test_texts_of_one_template_are_not_compared(spark, monkeypatch):
    template = " ".join(f"t{i}" for i in range(80))
    texts = [template + " " + " ".join(f"u{n}x{i}" for i in range(40)) for n in range(400)]
    texts += [texts[n] + " end" for n in range(0, 400, 100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    sizes = dealt(monkeypatch)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicate_groups(docs).collect()}
    want = {i: i for i in range(400)} | {400 + i: 100 * i for i in range(4)}
    assert got == want and sum(sizes) <= 8


@pytest.mark.parametrize("k", [1, 4])
def test_families_near_the_least_similarity(spark, monkeypatch, k):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng = random.Random(k)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for n in range(220):
        words = list(base)
        for _ in range(rng.randrange(1, 5)):
            words[rng.randrange(len(words))] = f"n{n}x{rng.randrange(3)}" if n % 3 else f"s{rng.randrange(9)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicate_groups(docs, k, 92 if k == 1 else 80).collect()}
    assert [got[i] for i in range(len(texts))] == components(texts, k, 92 if k == 1 else 80)

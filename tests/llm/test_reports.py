"""Phrases, embedding duplicates and the filter audit, against plain versions."""

from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from postmill.llm import audit, phrases, tiles
from tests.llm.cases import DOCS, documents, lower, sentence

# --- phrases ------------------------------------------------------------------------------


def plain_phrases(rows: list[tuple], least: int, percent: int, top: int) -> list[tuple]:
    """(lang, rank, phrase, a, l, r, n, score) of (text, lang)."""
    f: dict = {}
    for text, lang in rows:
        counts = f.setdefault(lang or "und", Counter()) if re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]", text or "") else Counter()
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            counts.update(tuple(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        n = sum(a for p, a in counts.items() if len(p) == 1)
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longest = Counter()
        for p, a in candidates.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    longest[part] = max(longest[part], a)
        found = []
        for p, a in candidates.items():
            if 100 * longest[p] >= percent * a and longest[p]:
                continue
            score, _, left, right = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, at + 1, p.decode(), -a, left, right, n, -s) for at, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def texts() -> list[tuple]:
    rows = [(t, lang) for _, t, lang, *_ in documents()]
    rows += [("The cat sat. the CAT sat, the cat; the cat\tsat\nthe cat sat on", "en")] * 4
    rows += [("hot pair " + " hot pair ".join(f"z{k % 7}" for k in range(300)), None), ("é漢 字ü é漢 字ü " * 9, "zz"), (".,;", "qq"), ("one", "one word")]
    rows += [(sentence(5, 40).replace(" ", "\x0b", 3) + "!\x00 x \xa0 y", "de")] * 3
    return rows


@pytest.mark.parametrize("all_hot", [False, True])
def test_phrases_are_those_of_plain_counting(spark, monkeypatch, all_hot):
    if all_hot:  # every first word and every pair is dealt by more words
        monkeypatch.setattr(phrases, "LEAST_SAMPLED", 1)
        monkeypatch.setattr(phrases, "HOT_SHARE", 10**9)
        monkeypatch.setattr(phrases, "SLICE", 3000)
        monkeypatch.setattr(phrases, "LEAST_BUCKETS", 5)
    rows = texts()
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(3).withColumns({c: F.lit(7) for c in ("w1", "a", "rank", "bucket", "word", "n")})
    for least, top in ((2, 2000), (3, 7)):
        found = phrases.collocations(frame, least=least, top=top).collect()
        assert sorted(tuple(r) for r in found) == plain_phrases(rows, least, 50, top)


def test_phrases_of_nothing(spark):
    for rows in ([], [(None, None), ("", "en"), (" . ", "en")]):
        assert phrases.op11(spark.createDataFrame(rows, "text string, lang string")).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 123_456_789_012, 987_654_321_098_765, 123_456_789_013
    row = spark.sql(f"select {a}L as a, {left}L as l, {right}L as r").select(phrases._score("a", "l", "r").alias("s")).first()
    assert row.s == 1_000_000 * a * a // (left * right)


# --- embeddings ---------------------------------------------------------------------------


def plain_links(rows: list[tuple], threshold: float) -> list[tuple]:
    good = {k: np.array(v, float) for k, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)}
    near: dict = {k: set() for k in range(len(rows))}
    for i, x in good.items():
        for j, y in good.items():
            if i != j and len(x) == len(y):
                x1, y1 = x / abs(x).max(), y / abs(y).max()
                if (x1 * y1).sum() / np.sqrt((x1 * x1).sum() * (y1 * y1).sum()) >= threshold:
                    near[i].add(j)
    out = []
    for k, (vec_id, _) in enumerate(rows):
        reached, todo = {k}, [k]
        while todo:
            fresh = near[todo.pop()] - reached
            reached |= fresh
            todo += fresh
        least = min((rows[r][0] for r in reached if rows[r][0] is not None), default=None)
        out.append((vec_id, len(near[k]), least, vec_id == least))
    return sorted(out, key=str)


def vectors(size: int = 64) -> list[tuple]:
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, size)) * np.linspace(3, 0.2, size)
    rows = [(1000 + i, (centres[i % 12] + rng.normal(size=size) * rng.choice([0.05, 0.3, 0.9])).astype(np.float32).tolist()) for i in range(500)]
    rows += [(i, rows[3][1]) for i in range(60)] + [(None, rows[8][1]), (None, rng.normal(size=size).astype(np.float32).tolist())]
    rows += [(70, (4 * np.array(rows[3][1], np.float32)).tolist()), (71, (-np.array(rows[3][1], np.float32)).tolist()), (72, [1e30] * size), (73, [1e-30] * size)]
    rows += [(80, None), (81, []), (82, [0.0] * size), (83, [None] + [1.0] * (size - 1)), (84, [float("nan")] * size), (85, [float("inf")] * size)]
    rows += [(90 + k, [1.0, 2.0 + k / 10, 3.0]) for k in range(5)] + [(96, [2.0]), (97, [5.0]), (98, [-1.0]), (1000, rows[40][1])]
    steps = rng.normal(size=size)
    other = rng.normal(size=size)
    rows += [(3000 + k, (steps * np.cos(k / 5) + other * np.sin(k / 5)).tolist()) for k in range(30)]  # a chain
    return rows


@pytest.mark.parametrize("tile", [16, 4096])
def test_embedding_links_are_those_of_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(tiles, "PART", 50)
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3).withColumns({c: F.lit(1) for c in ("cid", "tile", "n", "v")})
    found = tiles.duplicates(frame, tile=tile)
    assert sorted((tuple(r) for r in found.collect()), key=lambda r: str((r[0], r[1], r[2], r[3]))) == plain_links(rows, 0.9)


def test_far_tiles_are_not_compared(spark):
    """Two bundles of opposite vectors are never laid side by side."""
    rng = np.random.default_rng(1)
    rows = [(0, 8, k, [s * (1.0 - 0.01 * rng.random())] + [0.0] * 7, [s * 1.0] + [0.01] * 7) for k, s in enumerate((-1, -1, 1, 1))]
    rows = [(size, t, [min(a, b) for a, b in zip(low, high)], [max(a, b) for a, b in zip(low, high)]) for _, size, t, low, high in rows]
    pairs = tiles.tile_pairs(spark.createDataFrame(rows, "size int, tile long, low array<double>, high array<double>"), 0.9)
    assert sorted((r.a, r.b) for r in pairs.collect()) == [(0, 0), (0, 1), (1, 1), (2, 2), (2, 3), (3, 3)]


def test_suffix_bounds_lose_no_pair():
    rng = np.random.default_rng(2)
    for scale in (0.05, 0.5, 5):
        x = tiles.unit(rng.normal(size=(90, 64)) * np.linspace(scale, 0.1, 64))
        i, j = tiles.linked(x[:40], x[40:], 0.6)
        want = {(a, b) for a, b in zip(*np.nonzero(x[:40] @ x[40:].T >= 0.6))}
        assert want <= set(zip(i.tolist(), j.tolist())) and len(set(zip(i.tolist(), j.tolist()))) == len(i)


def test_embeddings_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert tiles.op12(none).collect() == []
    assert tiles.op12(none).columns == ["vec_id", "n_links", "component_id", "kept"]
    assert [tuple(r) for r in tiles.op12(spark.createDataFrame([(4, None)], none.schema)).collect()] == [(4, 0, 4, True)]


# --- filter audit -------------------------------------------------------------------------


def plain_audit(docs: list[tuple], labels: dict) -> list[tuple]:
    """Rows of the audit of (doc_id, text, lang)."""
    first: dict = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    masks = []
    for i, text, lang in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and first[t] < i,
        }
        masks.append((lang or "", {k for k, bad in fails.items() if bad}, *labels.get(i, (None, None))))
    out, shapley = [], Counter()
    for part in {m[0] for m in masks}:
        for order in permutations("ABCDE"):
            left = [m for m in masks if m[0] == part]
            for step, letter in enumerate(order, 1):
                own = [m for m in masks if m[0] == part and letter in m[1]]
                gone = [m for m in left if letter in m[1]]
                left = [m for m in left if letter not in m[1]]
                shapley[part, letter] += len(gone)
                out.append([part, "".join(order), step, len(left), len(gone), len(own) - len(gone), sum(m[1] == {letter} for m in own), sum(m[2] == 1 for m in gone), sum(m[3] == 1 for m in gone)])
    return sorted((*row, shapley[row[0], row[1][row[2] - 1]]) for row in out)


def audit_documents() -> list[tuple]:
    rows = [(i, t, lang) for i, t, lang, *_ in documents()]
    base = sentence(3, 250)
    rows += [(500 + k, base + f" end {k % 4}", "en") for k in range(40)] + [(600 - k, base + " end 1", None) for k in range(30)]
    rows += [(700, base[:k], "de") for k in (16, 17, 64, 65, 200)] + [(701, base[:64], "fr"), (701, base[:64], "fr"), (2, base[:17], "fr")]
    rows += [(None, base, "en"), (None, base, "en"), (800, "a" * 70_000, "en"), (799, "a" * 70_000, "en"), (798, "a" * 69_999, "en"), (803, "ÄÖ $5 " * 50, "de"), (804, "LOUD " * 30, "de")]
    return rows


@pytest.mark.parametrize("part_bytes", [2000, 32 << 20])
def test_audit_is_that_of_every_order(spark, part_bytes):
    rows = audit_documents()
    labels = {i: (k % 2, (k // 2) % 2) for k, i in enumerate(sorted({r[0] for r in rows if r[0]})[::2])}
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4).withColumns({c: F.lit("x") for c in ("part", "fails", "n", "prefix", "good")})
    known = spark.createDataFrame([(i, *x) for i, x in labels.items()] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    counts = audit.mask_counts(audit.flagged(frame, part_bytes), known)
    found = audit.orders_replayed(counts).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert sorted(tuple(r) for r in found.collect()) == plain_audit(rows, labels)


def test_trie_holds_each_text_once():
    trie, texts = audit.Trie(), [b"", b"a", b"ab", b"abc", b"abd", b"b", b"abcdef" * 50, b"abcdef" * 49, b"ab" * 999]
    for at, text in enumerate(texts * 2):
        holder = trie.holder(text)
        holder[0] = at if holder[0] is None else holder[0]
    assert sorted(h[0] for h in trie.terminals()) == list(range(len(texts)))
    assert all(trie.holder(t)[0] == at for at, t in enumerate(texts))


def test_audit_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert audit.op13(none, labels).collect() == []
    rows = audit.op13(spark.createDataFrame([(1, None, None, None, None)], DOCS), labels).collect()
    assert len(rows) == 600 and all((r.part, r.good_lost) == ("", 0 if r.removed == 0 else 1) for r in rows)

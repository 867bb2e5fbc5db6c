"""Sharding, mixing and near duplicates against plain versions."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import pytest

from postmill.llm import jaccard, mix, shard
from tests.llm.cases import DOCS, changed, documents, lower, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), DOCS)


# --- sharding ---------------------------------------------------------------------------


def feistel(number: int, n: int, seed: int = shard.SEED) -> int:
    a, b = shard.sides(n)
    keys = shard.round_keys(seed)

    def mixed(v: int, k: int) -> int:
        return (((v + k) * (v + k + 1)) % shard.PRIME * shard.FACTOR + k) % shard.PRIME

    while True:
        x, y = divmod(number, b)
        for k, m in keys:
            x = (x + mixed(y, k)) % a
            y = (y + mixed(x, m)) % b
        number = x * b + y
        if number < n:
            return number


@pytest.mark.parametrize("n", [1, 2, 3, 24, 97, 1000])
def test_network_permutes(n):
    assert sorted(feistel(i, n) for i in range(n)) == list(range(n))


def test_shards_are_even_gapless_and_computable(docs):
    rows = shard.op10(docs).collect()
    assert len(rows) == len(documents())
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert divmod(feistel(r.row_no, r.n_rows), 24) == (r.slot, r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = defaultdict(set)
    for i, text, *_ in documents():
        texts[i].add(((len((text or "").encode()) + 8), zlib.crc32((text or "").encode())))
    assert all((r["size"], r.text_crc32) in texts[r.doc_id] for r in rows)


def test_shards_do_not_depend_on_partitions(docs):
    one = {tuple(r) for r in shard.op10(docs.coalesce(1)).collect()}
    assert one == {tuple(r) for r in shard.op10(docs.repartition(7)).collect()}


def test_sharding_keeps_columns_and_takes_names_over(docs):
    clash = docs.selectExpr("*", "'old' as shard", "map('a', 1) as inside", "1 as row_no")
    found = shard.sharded(clash)
    assert found.columns == [*DOCS.replace(",", "").split()[::2], "inside", "row_no", "shard", "slot"]
    assert found.count() == len(documents()) and dict(found.dtypes)["shard"] == "int"


def test_sharding_of_nothing(docs):
    assert shard.op10(docs.limit(0)).count() == 0


# --- mixing -----------------------------------------------------------------------------


def targets(sizes: dict) -> dict:
    """Deal, stop at twice the size, deal the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 2.0 * sizes[s] for s in over}


def test_mix_meets_targets(docs):
    rows = mix.op5(docs.drop("n_chars")).collect()
    sizes, where = Counter(), defaultdict(set)
    for i, text, _, source, _ in documents():
        sizes[source] += len(WORD.findall(text or ""))
        where[i].add(source)
    wanted = targets(sizes)
    assert sorted(wanted, key=str) == sorted(sizes, key=str)
    taken: Counter = Counter()
    for r in rows:
        source = next(s for s in where[r.doc_id] if sizes[s] == r.source_size)
        assert r.target == pytest.approx(wanted[source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[source] += r.taken
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= 4 * mix.BLOCK
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mix.op5(docs.repartition(5)).collect()), key=str)


def taken_words(rows: list[tuple], wanted: dict) -> dict:
    """{key: words} by a plain schedule, from (key, source, size, place), word by word."""
    order = sorted(wanted, key=lambda s: (s is None, s or ""))
    words = {s: [r[0] for r in sorted((x for x in rows if x[1] == s), key=lambda x: (x[3] % mix.BUCKETS, x[3], x[0])) for _ in range(r[2])] for s in order}
    n_blocks = {s: max(-(-len(w) // mix.BLOCK), min(len(w), mix.LEAST_BLOCKS)) for s, w in words.items()}
    due = {s: max(round(wanted[s] / len(words[s]) * n_blocks[s]), 1) if words[s] else 0 for s in order}
    whole, ends, total = sum(due.values()), [], 0
    for s in order:
        total += due[s]
        ends.append(total / whole)
    dealt: Counter = Counter()
    for k in range(whole):
        point = k * mix.GOLDEN % mix.UNITS / mix.UNITS
        dealt[next((s for s, end in zip(order, ends, strict=True) if point < end), order[-1])] += 1
    assert all(abs(dealt[s] - due[s]) <= 8 for s in order)  # the schedule itself is near
    found: Counter = Counter()
    for s in order:
        for rank in range(due[s]):
            block, w = rank % n_blocks[s], words[s]
            found.update(w[block * len(w) // n_blocks[s] : (block + 1) * len(w) // n_blocks[s]])
    return found


def test_taken_words_are_those_of_a_plain_schedule(docs):
    slim = docs.where("text is not null").select("doc_id", "source", "text")
    rows = [((r.row.k1, r.row.k2), r.source, r["size"], r.place) for r in mix.words_of(slim, 0).collect()]
    sizes: Counter = Counter()
    for _, source, size, _ in rows:
        sizes[source] += size
    want = taken_words(rows, targets(sizes))
    got: Counter = Counter()
    for r in mix.mixed(slim).collect():
        got[(r.row.k1, r.row.k2)] += r.taken
    assert got == want


def test_golden_points_keep_their_precision(spark):
    numbers = [0, 1, 2, 3, 10**6, (1 << 40) - 1, 10**12 + 7, 1 << 60]
    found = spark.createDataFrame([(n,) for n in numbers], "n long").select(mix.golden_point(mix.F.col("n")).alias("p")).collect()
    assert [r.p for r in found] == [n * mix.GOLDEN % mix.UNITS / mix.UNITS for n in numbers]


def test_equal_rows_share_their_copies(spark):
    rows = [(None, "same words in each of them", "a", {"k": 1})] * 40 + [(k, f"other text {k} of five", "b", {"k": k}) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, more map<string,int>")
    copies: Counter = Counter(r.text for r in mix.mixture(docs).collect())
    taken = sum(r.taken for r in mix.op5(docs).collect() if r.doc_id is None)
    assert abs(copies["same words in each of them"] - taken / 6) <= 20
    assert all(n <= 2 for text, n in copies.items() if text.startswith("other"))


def test_small_sources_keep_their_targets(spark):
    sizes = {f"s{k:03}": (30, 50, 100, 7, 1, 65)[k % 6] for k in range(120)} | {"big": 4000}
    rows = [(k * 1000 + j, "w " * (n // 4 + (j < n % 4)), s) for k, (s, n) in enumerate(sizes.items()) for j in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken: Counter = Counter()
    source = {i: s for i, _, s in rows}
    found = mix.op5(docs).collect()
    for r in found:
        taken[source[r.doc_id]] += r.taken
        assert 0 <= r.taken <= 2 * r["size"]
    for s, target in targets(sizes).items():
        assert taken[s] > 0 and abs(taken[s] - target) <= max(1, sizes[s] / 60), s
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.01)
    assert {r.source for r in mix.mixture(docs).collect()} == set(sizes)


def test_a_source_of_one_long_text_stays(spark):
    docs = spark.createDataFrame([(1, "w " * 900, "a"), (2, "w " * 5000, "b")], "doc_id long, text string, source string")
    docs = docs.unionByName(spark.createDataFrame([(3, "w " * 5000, "c"), (4, "w " * 100_000, "b")], docs.schema))
    assert {r.source for r in mix.mixture(docs).collect()} == {"a", "b", "c"}


def test_mix_of_no_words_and_no_rows(spark, docs):
    rows = mix.op5(docs.where("doc_id in (60, 61)")).collect()
    assert {(r.target, r.taken) for r in rows} == {(0.0, 0)} and len(rows) == 2
    assert mix.op5(docs.limit(0)).count() == 0


def test_mixture_returns_documents(docs):
    clash = docs.selectExpr("*", "1 as taken", "2 as sid", "3 as block", "4 as row")
    found = mix.mixture(clash)
    assert found.columns == clash.columns
    copies = Counter(r.doc_id for r in found.collect())
    assert copies and max(copies.values()) <= 4  # id 80 is there twice


# --- near duplicates --------------------------------------------------------------------


def components(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id) from all pairs."""
    sets = []
    for _, text, *_ in rows:
        w = WORD.findall(lower(text))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    ids = defaultdict(list)
    for k, (i, *_) in enumerate(rows):
        ids[group[k]].append(i)
    least = {g: min((i for i in own if i is not None), default=None) for g, own in ids.items()}
    return sorted(((i, len(sets[k]), least[group[k]]) for k, (i, *_) in enumerate(rows)), key=str)


@pytest.mark.parametrize("region", [jaccard.REGION, 4])
def test_near_duplicates_are_exact(docs, region):
    found = sorted(map(tuple, jaccard.near_duplicates(docs.select("doc_id", "text"), region).collect()), key=str)
    assert found == components(documents())


def test_regions_are_bounded_by_bytes(spark, monkeypatch):
    """Few but long texts: parts and blocks by their bytes, with the same groups."""
    base, other = sentence(21, 1500), sentence(22, 40)
    rows = [(k, changed(base, k, 1 + 9 * k)) for k in range(24)] + [(100 + k, base[:4000] + " " + sentence(300 + k, 900)) for k in range(8)]
    rows += [(200 + k, changed(other, k, k)) for k in range(4)] + [(300, None), (301, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    placed = jaccard._texts_of
    monkeypatch.setattr(jaccard, "_texts_of", lambda docs, wanted: seen.append(wanted) or placed(docs, wanted))
    found = jaccard.near_duplicates(frame, size=100_000).collect()
    assert sorted(map(tuple, found), key=str) == components(rows)
    per_part = seen[0].groupBy("pivot", "part").count().agg({"count": "max"}).first()[0]
    assert seen[0].agg({"part": "max"}).first()[0] >= 2 and per_part < 24 and len(seen) == 2


def test_a_linked_row_without_an_id_stands_for_nothing(spark):
    """Copies and near copies with null ids take the smallest id that there is; one without any has none."""
    base, other = documents()[0][1], documents()[12][1]
    rows = [(5, base), (None, base), (7, base + " and more"), (None, base + " at last"), (None, other + " zz"), (None, other + " yy"), (None, "alone here it is now")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard.near_duplicates(frame).collect()), key=str) == components(rows)
    kept = sorted((tuple(r) for r in jaccard.deduplicated(frame).collect()), key=str)
    assert len(kept) == 3 and (5, base) in kept


@pytest.mark.parametrize("region", [jaccard.REGION, 8])
def test_chains_and_a_large_group(spark, region):
    base = sentence(5, 120)
    rows = [(1000 + k, changed(base, k, 1 + k % 9)) for k in range(60)]
    step = sentence(6, 200)
    for k in range(25):  # each links with the next only
        rows.append((500 - k, step))
        parts = step.split(" ")
        parts[8 * k : 8 * k + 4] = [f"s{k}a", f"s{k}b", f"s{k}c", f"s{k}d"]
        step = " ".join(parts)
    rows += [(2000 + k, sentence(9, 12) + " " + sentence(3000 + k, 60)) for k in range(40)]  # a shared passage
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), region).collect()
    assert sorted(map(tuple, found), key=str) == components(rows)


def test_one_of_each_group_stays(docs):
    clash = docs.selectExpr("*", "1 as n", "2 as class", "'x' as root", "4 as row")
    found = jaccard.deduplicated(clash)
    assert found.columns == clash.columns
    kept = Counter(r.doc_id for r in found.collect())
    first = {c for i, n, c in components(documents()) if n}
    assert kept == Counter([*first, 60, 61, 62])
    assert jaccard.op9(docs.limit(0)).count() == 0 and jaccard.deduplicated(docs.limit(0)).count() == 0

"""Filter audit, SimHash classes and whitening against plain versions of the same definitions, and hard inputs."""

import re
from collections import defaultdict
from fractions import Fraction
from itertools import combinations, permutations

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from check import _plain
from rollbook.llm import filter_audit, simhash, whitening
from rollbook.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
HARD = [
    (1, "The same text", "a"), (2, "The same text", "a"), (2, "The same text", "b"), (3, None, None), (4, "", "a"), (None, "The same text", "a"),
    (5, " \n\t\v\f\r ", "b"), (6, " ".join(f"W{i % 997}q" for i in range(250_000)), "b"), (7, "# ÀÉ one", ""), (8, "0" * 50_000 + " " + "é🙂" * 9_000, "c"), (9, "The  Same\ntext", "c"),
]
CLASHING = ("digest", "part", "mask", "n", "good", "toxic", "rows", "first", "key", "fingerprint", "node", "root", "component_id", "x", "place", "label")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(HARD, "doc_id long, text string, source string").withColumns({c: F.lit("x") for c in CLASHING}).cache()


# filter audit


def plain_steps(docs, labels):
    """Counts by applying every order to every document."""
    first = {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    good, toxic = ({d for d, q, x in labels if d is not None and (q, x)[k] == 1} for k in range(2))
    parts = defaultdict(list)
    for d, t, source in docs:
        t = t or ""
        words = WORD.findall(t)
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": d is not None and d > first[t],
        }
        parts[source or ""].append((frozenset(f for f, x in fails.items() if x), d in good, d in toxic))
    out = []
    for part, rows in parts.items():
        shares, steps = defaultdict(int), []
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                shares[f] += len(gone)
                failing = sum(f in r[0] for r in rows)
                steps.append((part, "".join(order), step, len(left), len(gone), failing - len(gone), sum(r[0] == {f} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone), f))
        out += [(*s[:-1], shares[s[-1]]) for s in steps]
    return sorted(out)


def test_audit_against_plain_orders_and_sql(spark):
    found = QUERIES["op11_filter_audit"](spark, SF)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert sorted(map(tuple, found.collect())) == plain_steps(rows, labels)
    db = duckdb.connect()
    for t in ("documents", "labels"):
        db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    ours = found.toPandas()
    theirs = db.sql(ORACLES["op11_filter_audit"]).df()
    assert sorted(ours.columns) == sorted(theirs.columns) and _plain(ours) == _plain(theirs)


def test_audit_hard_inputs(spark, docs):
    marks = [(1, 1, 0), (2, 0, 0), (2, 1, None), (None, 1, 1), (3, None, 1), (77, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int").withColumns({"part": F.lit(1), "n": F.lit("x")})
    assert sorted(map(tuple, filter_audit.audit(docs, labels).collect())) == plain_steps(HARD, marks)
    assert filter_audit.audit(docs.where("false"), labels).count() == 0
    assert sorted(map(tuple, filter_audit.audit(docs, labels.where("false")).collect())) == plain_steps(HARD, [])


@pytest.mark.parametrize("players", [2, 3, 5])
def test_shapley_of_any_game_is_exact(players):
    rng = np.random.default_rng(players)
    v = [0, *rng.integers(-9, 50, (1 << players) - 1).tolist()]
    orders = list(permutations(range(players)))
    plain = [Fraction(0)] * players
    for order in orders:
        before = 0
        for i in order:
            plain[i] += Fraction(v[before | 1 << i] - v[before], len(orders))
            before |= 1 << i
    assert filter_audit.shapley_shares(v) == plain


# SimHash


def plain_fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    made = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in made]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, radius=4):
    """Smallest id of each component of (id, fingerprint) rows."""
    nodes = sorted(set(f for _, f in prints))
    root = {f: f for f in nodes}

    def find(f):
        while root[f] != f:
            root[f] = root[root[f]]
            f = root[f]
        return f

    values = np.array(nodes, np.uint64)
    for i, f in enumerate(nodes):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= radius):
            root[find(nodes[i + 1 + j])] = find(f)
    least = defaultdict(list)
    for d, f in prints:
        least[find(f)].append(d)
    return {f: min((d for d in least[find(f)] if d is not None), default=None) for f in nodes}


def test_simhash_against_plain(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = [(d, plain_fingerprint(t)) for d, t in texts.items()]
    expected = plain_classes(prints)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op12_simhash_dedup"](spark, SF).collect()}
    assert found == {d: (f"{f:016x}", expected[f]) for d, f in prints}
    assert len(set(expected.values())) < len(texts)


@pytest.fixture(scope="module")
def clouds():
    """Fingerprints at random, round three centres (dense and by chains), near zero, and with the sign bit."""
    rng = np.random.default_rng(8)
    made = set(rng.integers(0, 1 << 64, 1500, np.uint64).tolist()) | {0, 1, 15, 31, 1 << 63, (1 << 64) - 1}
    for centre in rng.integers(0, 1 << 64, 3, np.uint64).tolist():
        for _ in range(500):
            made.add(centre ^ sum(1 << b for b in set(rng.integers(0, 64, int(rng.integers(0, 11))).tolist())))
    at = int(rng.integers(0, 1 << 62))
    for _ in range(60):
        at ^= sum(1 << b for b in set(rng.integers(0, 64, 4).tolist()))
        made.add(at)
    return sorted(made)


@pytest.mark.parametrize(("width", "full"), [(3, simhash.FULL), (4, simhash.FULL), (3, 40), (None, 9)])
def test_simhash_links_connect_all_near_fingerprints(spark, clouds, width, full):
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in clouds], "fingerprint long")
    found = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(nodes, width, full).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    root = {f: f for f in clouds}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in found:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    ours = defaultdict(set)
    for f in clouds:
        ours[find(f)].add(f)
    plain = plain_classes([(f, f) for f in clouds])
    theirs = defaultdict(set)
    for f in clouds:
        theirs[plain[f]].add(f)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_position_sets_meet_any_four_positions():
    assert len(simhash.position_sets(3)) == 20 and len(simhash.position_sets(4)) == 70
    for four in combinations(range(8), 4):
        assert any(set(t) <= set(four) for t in simhash.position_sets(3))


def test_simhash_hard_inputs(docs):
    found = sorted(((r["doc_id"], r["fingerprint"] % (1 << 64), r["component_id"]) for r in simhash.near_classes(docs).collect()), key=str)
    prints = [(d, plain_fingerprint(t)) for d, t, _ in HARD]
    expected = plain_classes(prints)
    assert found == sorted(((d, f, expected[f]) for d, f in prints), key=str)
    assert {d: c for d, _, c in found}[9] == 1 and {d: c for d, _, c in found}[4] == 3
    assert simhash.near_classes(docs.where("false")).count() == 0


def test_long_text_is_read_in_pieces(monkeypatch):
    text = HARD[7][1]
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_PART_BYTES", 7)
    assert simhash.fingerprint(text[:9_000]) == plain_fingerprint(text[:9_000]) and whole == plain_fingerprint(text)


# whitening


def plain_whitening(rows):
    """(id, component) -> deviation, |whitened|; and the shares of variance, by a dense solver over the distinct grid vectors."""
    grid = [(i, tuple(int(np.floor(256 * float(e))) for e in v)) for i, v in rows]
    fit = np.array(sorted(set(x for _, x in grid)), float)
    n, sums = len(fit), [sum(c) for c in zip(*set(x for _, x in grid))]
    away = fit - fit.mean(axis=0)
    values, vectors = np.linalg.eigh(away.T @ away / n)
    order = np.argsort(-values)[:4]
    out = {}
    for i, x in grid:
        deviation = sum((n * v - s) ** 2 for v, s in zip(x, sums))
        along = (np.array(x) - fit.mean(axis=0)) @ vectors[:, order] / np.sqrt(values[order])
        for k in range(len(order)):
            out[i, k + 1] = (deviation, along[k])
    return n, out, values[order] / values.sum()


def test_whitening_against_dense_solver(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    n, expected, explained = plain_whitening(rows)
    found = QUERIES["op13_embedding_whitening"](spark, SF).collect()
    assert len(found) == len(expected) == 4 * len(rows)
    signs = {k: np.sign(sum(r["whitened"] * expected[r["vec_id"], k][1] for r in found if r["component"] == k)) for k in range(1, 5)}
    for r in found:
        deviation, along = expected[r["vec_id"], r["component"]]
        assert r["n"] == n and r["deviation"] == deviation
        assert abs(r["whitened"] - signs[r["component"]] * along) < 1e-9
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-10 and r["identity_error"] < 1e-10


@pytest.mark.parametrize(("size", "number", "spread"), [(64, 300, 100), (6, 40, 3), (5, 3, 1000), (1, 9, 50), (12, 200, 1)])
def test_spectra_by_updates_equal_the_scatter_matrix(size, number, spread):
    rng = np.random.default_rng(size)
    x = rng.integers(-spread, spread + 1, (number, size)).astype(float)
    x[number // 2 :, 0] = x[0, 0]
    parts = []
    for piece in np.array_split(x, 4):
        seen = whitening._empty(size)
        for row in piece:
            seen = whitening.add_vector(seen, row, [int(v) for v in row])
        parts.append(seen)
    whole = parts[0]
    for s in parts[1:]:
        whole = whitening.combine(whole, s)
    away = x - x.mean(axis=0)
    scatter = away.T @ away
    assert whole.n == number and whole.sums == x.sum(axis=0).astype(int).tolist()
    assert np.abs(whole.basis.T @ whole.basis - np.eye(size)).max() < 1e-12
    assert np.abs(whole.basis * whole.values @ whole.basis.T - scatter).max() <= 1e-12 * max(np.abs(scatter).max(), 1)


def test_secular_roots_of_close_poles():
    d = np.array([0.0, 1.0, 1.0 + 1e-9, 2.0, 1e8])
    z = np.array([0.5, 1e-4, 0.3, 1e-6, 0.8])
    roots, away = whitening.secular_roots(d, z, 3.0)
    assert all(d[i] < roots[i] or away[i, i] < 0 for i in range(5)) and all(away[i, i + 1] > 0 for i in range(4))
    dense = np.linalg.eigvalsh(np.diag(d) + 3.0 * np.outer(z, z))
    assert np.abs(roots - dense).max() < 1e-7


def test_whitening_in_rounds_of_merges(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 3)
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=6) * [3, 2, 1, 0.5, 0.2, 0.1] + 40).tolist()) for i in range(400)]
    _, expected, _ = plain_whitening(rows)
    found = whitening.whitened(spark.createDataFrame(rows, "vec_id long, v array<double>").repartition(23), "vec_id", "v").collect()
    signs = {k: np.sign(sum(r["whitened"] * expected[r["vec_id"], k][1] for r in found if r["component"] == k)) for k in range(1, 5)}
    assert max(abs(r["whitened"] - signs[r["component"]] * expected[r["vec_id"], r["component"]][1]) for r in found) < 1e-9


def test_whitening_hard_inputs(spark):
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=3).tolist()) for i in range(40)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [float("nan"), 0.0, 0.0]), (104, [0.0, float("-inf"), 0.0]), (105, [1e300, 0.0, 0.0]), (106, [1.0, 2.0])]
    made = good + [(0, good[0][1]), (None, good[1][1])]
    vectors = spark.createDataFrame(made + bad, "vec_id long, v array<double>").withColumns({c: F.lit("x") for c in CLASHING + ("component", "size", "n")})
    found = whitening.whitened(vectors, "vec_id", "v").collect()
    n, expected, _ = plain_whitening(good)
    assert {r["n"] for r in found} == {n} == {40} and len(found) == 3 * len(made)
    assert {r["vec_id"] for r in found} == {i for i, _ in made} and all(r["deviation"] == expected[r["vec_id"], r["component"]][0] for r in found if r["vec_id"] is not None)
    assert whitening.whitened(vectors.where("false"), "vec_id", "v").count() == 0
    assert whitening.whitened(vectors.where("vec_id = 0"), "vec_id", "v").count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0]) for i in range(9)], "vec_id long, v array<float>")
    assert {r["component"] for r in whitening.whitened(line, "vec_id", "v").collect()} == {1}
    large = spark.createDataFrame([(i, [3e9 * i, float(i % 3)]) for i in range(2_000)], "vec_id long, v array<double>")
    assert {r["deviation"] is None for r in whitening.whitened(large, "vec_id", "v").where("vec_id = 0").collect()} == {True}

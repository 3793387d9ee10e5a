"""Vector codes, manifest and nearest neighbours against plain definitions, with awkward rows."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tables import sf_dir  # noqa: F401
from pyspark.sql import functions as F

from commerce_lake.llm import merkle, queries, vector_codes, vector_search

rng = np.random.default_rng(5)
VECTORS = "vec_id long, embedding array<float>, label int, code string, list int, node string"


def _table(spark, rows):
    """(vec_id, embedding, label) with further columns of clashing names."""
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], VECTORS)


def _plain(v):
    return None if v is None else [None if x is None else float(x) for x in v]


def _usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


AWKWARD = [None, [], [None] * 8, [0.5] * 7 + [None], [math.nan] * 8, [math.inf] + [0.0] * 7, [1.0, 2.0]]


def _awkward_rows(n, size=8):
    centres = rng.normal(size=(12, size))
    rows = [(i, (centres[i % 12] + 0.2 * rng.normal(size=size)).astype(np.float32).tolist(), i % 5 or None) for i in range(n)]
    rows += [(1000 + i, v, 3) for i, v in enumerate(AWKWARD)]
    common = rows[3][1]
    rows += [(2000 + i, common, None) for i in range(n // 2)]  # a third of all rows is one vector
    rows += [(5, rows[5][1], 1), (6, rows[7][1], 2), (None, rows[8][1], 4), (3000, [-0.0] * size, 1), (3001, [0.0] * size, 1)]
    random.Random(1).shuffle(rows)
    return rows


def _codes(rows, entries, rounds, parts=4):
    kept = [(i, v, label) for i, v, label in rows if _usable(v) and len(v) == 8]
    ints = np.array([[math.floor(1024 * x) for x in v] for _, v, _ in kept], object)
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    width = ints.shape[1] // parts
    books = [[list(ints[k][p * width : (p + 1) * width]) for k in first] for p in range(parts)]

    def nearest(p):
        part = ints[:, p * width : (p + 1) * width]
        away = np.array([[((x - np.array(e, object)) ** 2).sum() for e in books[p]] for x in part])
        return part, away.argmin(axis=1), away.min(axis=1)

    for _ in range(rounds):
        for p in range(parts):
            part, code, _ = nearest(p)
            for e in set(code):
                mine = part[code == e]
                books[p][e] = [s // len(mine) for s in mine.sum(axis=0)]
    codes, errors = [""] * len(kept), np.zeros(len(kept), object)
    for p in range(parts):
        _, code, away = nearest(p)
        codes = [c + f"{e:02x}" for c, e in zip(codes, code, strict=True)]
        errors += away
    return Counter((k[0], k[2], c, int(e)) for k, c, e in zip(kept, codes, errors, strict=True)), books


@pytest.mark.parametrize("leaf, block, entries", [(4, 60, 16), (1000, 1000, 256)])
def test_codes(spark, leaf, block, entries):
    rows = _awkward_rows(150)
    plan = vector_codes.Plan(entries=entries, leaf=leaf, block=block)
    coded, books = vector_codes.encode(_table(spark, rows), plan)
    assert coded.columns == ["vec_id", "label", "list", "node", "code", "error"]
    expected, expected_books = _codes(rows, entries, plan.rounds)
    assert Counter((r["vec_id"], r["label"], r["code"], r["error"]) for r in coded.collect()) == expected
    assert [b.tolist() for b in books] == expected_books


def test_codes_of_few_rows_and_large_components(spark):
    none, books = vector_codes.encode(_table(spark, [(1, None, 1), (2, [], 1)]))
    assert none.collect() == [] and [len(b) for b in books] == [0] * 4
    huge = [(i, [1e30, -1e30, 0.0, float(i)], i) for i in range(3)]
    coded, books = vector_codes.encode(_table(spark, huge))
    assert {(r["vec_id"], r["code"], r["error"]) for r in coded.collect()} == {(0, "00000000", 0), (1, "00000001", 0), (2, "00000002", 0)}
    assert books[0][0, 0] == vector_codes.BOUND and books[1][0, 0] == -vector_codes.BOUND
    assert {r["code"] for r in vector_codes.encode(_table(spark, [(1, [0.25], 1)]))[0].collect()} == {"00000000"}


def test_whole_nodes_and_ties():
    """Every kind of table: separated, random, of few values, and one value."""
    spread = rng.integers(-5000, 5000, (40, 6))[rng.integers(0, 40, 4000)] + rng.integers(-3, 4, (4000, 6))
    for items in (spread, rng.integers(-50, 50, (3000, 6)), rng.integers(0, 2, (3000, 3)), np.full((500, 4), 7)):
        tree, book = vector_codes.Tree.grow(items, 16), vector_codes.Book(items[:64])
        counts, sums, code = vector_codes.assign(tree, book)
        expected = ((items[tree.order][:, None] - items[None, :64]) ** 2).sum(-1).argmin(1)
        assert (code == expected).all() and (counts == np.bincount(expected, minlength=64)).all()
        assert (sums == np.array([items[tree.order][expected == e].sum(0) for e in range(64)])).all()
        same = vector_codes.Tree.read(items, 16, *tree.stored())
        assert (vector_codes.assign(same, book, leaf_values=False)[1] == sums).all()


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _manifest(rows):
    """Rows (doc_id, text, lang, source, n_chars) -> results by list position, from whole trees."""
    spell = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: _sha("".join(spell(v) for v in (r[0], r[3], r[2], r[4], text)))

    def altered(r):
        if r[0] is None or r[1] is None or zlib.crc32(str(r[0]).encode()) % 3:
            return leaf(r, r[1])
        return leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            below = levels[-1]
            levels.append([_sha("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
        return levels

    def climb(levels, at, seen, current):
        for level in levels[:-1]:
            run, k = level[at // 8 * 8 : at // 8 * 8 + 8], at % 8
            seen += "".join(run[:k] + run[k + 1 :])
            current = _sha("".join([*run[:k], current, *run[k + 1 :]]))
            at //= 8
        return seen, current

    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(r, r[1]), altered(r), r[0]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([m[2] for m in sorted(groups[g])]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    out = Counter()
    for k, g in enumerate(names):
        for at, (_, _, digest, changed, key) in enumerate(sorted(groups[g])):
            seen, current = climb(top, k, *climb(trees[g], at, "", changed))
            out[key, digest, trees[g][-1][0], top[-1][0], _sha(seen), current, current == top[-1][0]] += 1
    return out


def _documents(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("key", "digest", "tree", "at", "name", "leaf", "number"):
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


@pytest.mark.parametrize(
    "sizes", [{"en": 700, "de": 64, None: 9, "": 8, "fr": 1, "é": 65}, {"en": 1}, {"en": 5}, {"en": 70}, {f"l{i:02}": 1 for i in range(20)}, {}]
)
def test_manifest(spark, sf_dir, sizes):
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((i, f"Text {i} É" if i % 7 else None, lang, "S" if i % 3 else None, i if i % 5 else None))
            i += 1
    rows += [(2, "Again", "en", "S", 1), (2, "Again", "en", "S", 1), (None, "No Id", "en", None, None), (None, "", "en", None, None)] if i > 100 else []
    random.Random(2).shuffle(rows)
    found = queries.op12_merkle_manifest(spark, sf_dir(documents=_documents(spark, rows).repartition(5)))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, found.collect())) == _manifest(rows)


def test_proofs_find_every_change(spark):
    """Each field of each row matters, and moving a boundary between fields does too."""
    rows = [(i, f"ab{i}", "en", "s", i) for i in range(30)]
    df = _documents(spark, rows)
    for field in ("text", "source", "lang"):
        found = merkle.manifest(df, changed={field: F.when(F.col("doc_id") == 4, F.concat(F.lit("a"), field)).otherwise(F.col(field))})
        assert [r["doc_id"] for r in found.filter("folded <> root").collect()] == [4]
    one = merkle.digest([F.lit("ab"), F.lit("c")])
    assert spark.range(1).select(one == merkle.digest([F.lit("a"), F.lit("bc")])).first()[0] is False


def _nearest(rows, wanted, asks):
    some = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and _usable(v) and len(v) == 8 and any(v)]
    out = Counter()
    for k, (query, q) in enumerate(some):
        if asks(query):
            hits = sorted((-(q @ v), i) for j, (i, v) in enumerate(some) if j != k)[:wanted]
            for rank, (score, i) in enumerate(hits, 1):
                out[query, rank, i, round(-score, 9)] += 1
    return out


def _hits(df):
    return Counter((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in df.collect())


def test_search_is_exact_when_all_lists_are_probed(spark):
    rows = _awkward_rows(240)
    plan = vector_search.Plan(nearest=7, recall=1.0, error=1e-9, queries=16, candidates=32, width=3, asked=10_000)
    found = vector_search.search(_table(spark, rows), F.col("vec_id") % 4 == 0, plan)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    got, expected = _hits(found), _nearest(rows, 7, lambda i: i % 4 == 0)
    # Scores tie only for equal vectors here, so ids are fixed by the smaller key.
    assert got == expected


def test_search_of_varied_lengths_reaches_its_recall(spark, sf_dir):
    vectors = rng.normal(size=(3000, 24)) * rng.lognormal(size=(3000, 1))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]
    path = sf_dir(embeddings=spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    found = defaultdict(dict)
    for r in queries.op13_adaptive_dimension_scan(spark, path).collect():
        found[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    exact = np.array([v for _, v in rows])
    hits = 0
    assert sorted(found) == list(range(0, 3000, 20))
    for query, ranks in found.items():
        score = exact @ exact[query]
        score[query] = -np.inf
        top = np.argsort(-score)[:20]
        assert sorted(ranks) == list(range(1, 21)) and query not in {i for i, _ in ranks.values()}
        assert all(abs(score[i] - s) < 1e-9 for i, s in ranks.values())
        assert [s for _, (_, s) in sorted(ranks.items())] == sorted((s for _, s in ranks.values()), reverse=True)
        hits += len(set(top) & {i for i, _ in ranks.values()})
    assert hits >= 0.93 * 20 * len(found)


def test_search_of_little(spark):
    few = _table(spark, [(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, None, 1), (20, [0.0, 0.0], 1)])
    every = F.col("vec_id") % 20 == 0
    assert _hits(vector_search.search(few, every)) == Counter({(0, 1, 1, 0.5): 1})
    assert vector_search.search(few.limit(0), every).collect() == []
    assert vector_search.search(few.filter("vec_id > 1"), every).collect() == []
    twice = _table(spark, [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (0, [0.0, 1.0], 1)])
    assert _hits(vector_search.search(twice, every)) == Counter({(0, 1, 0, 1.0): 2, (0, 1, 0, 0.0): 1, (0, 2, 0, 0.0): 3})


def test_dimension_tests_abandon_most_candidates():
    size, plan = 64, vector_search.Plan()
    space = vector_search.Space(size, 1.0, plan)
    unit = rng.normal(size=(2100, size))
    unit /= np.sqrt((unit**2).sum(1))[:, None]
    asked, placed = space.asked(unit[:100]), space.placed(unit[100:])
    bound = np.sort(2 - 2 * unit[:100] @ unit[100:].T, axis=1)[:, 20]
    blocks = [placed[:, a:b] for a, b in space.blocks]
    i, j, away = vector_search._scanned(asked, blocks, bound, space)
    exact = 2 - 2 * (unit[i] * unit[100 + j]).sum(1)
    assert np.allclose(exact, away, atol=1e-5) and len(i) >= 0.99 * 21 * 100 and len(i) < 23 * 100
    # The last test but one has left a fraction of 200,000 pairs, though all but 2,100 are strangers at much the same distance.
    most = dict(zip(space.blocks, space.beyond, strict=True))
    partial = ((asked[:, None, : space.blocks[-2][1]] - placed[None, :, : space.blocks[-2][1]]) ** 2).sum(-1)
    assert (partial <= (bound * most[space.blocks[-2]])[:, None]).mean() < 0.25

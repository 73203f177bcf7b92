import os

import pytest

from accordant import queries
from accordant.config import DEFAULTS
from accordant.operators import blocking, clusters, exact, grouping, scoring
from accordant.operators.graph import components
from accordant.sources.tables import synthetic_names
from accordant.functions.text import normalise


def labels(df):
    return {r.node: r.label for r in df.collect()}


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 9)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = labels(components(spark.createDataFrame(edges, "a long, b long")))
    assert {got[i] for i in range(1, 41)} == {1} and {got[i] for i in range(100, 109)} == {100} and {got[i] for i in (200, 201, 202)} == {200} and 300 not in got


def test_components_without_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


ACCOUNTS = [("A1", "Walmart"), ("A2", "Walmart"), ("A3", "Walmart Inc"), ("A4", "Walmart Inc"), ("A5", "Target")]


def test_exact_groups(spark):
    rows = spark.createDataFrame(ACCOUNTS, "account_id string, account_name string")
    mapped = exact.exact_map(rows)
    assert {r.representative_id for r in exact.exact_groups(rows).collect()} == {"A1", "A3"}
    assert mapped.count() == 4 and exact.exact_pairs(mapped).count() == 2
    assert {r.account_id for r in exact.unique_records(rows, mapped).collect()} == {"A1", "A3", "A5"}


def test_gated_groups(spark):
    accounts = spark.createDataFrame([("a", "acme corp"), ("b", "acme widgets"), ("c", "other")], "account_id string, name_core string")
    pairs = spark.createDataFrame([("a", "b", 90), ("b", "c", 85)], "id_a string, id_b string, score int")
    got = grouping.create_groups(accounts, pairs, DEFAULTS.but(stop_tokens=("inc", "llc", "corp"))).collect()
    assert len(got) == 3 and len({r.group_id for r in got}) == 2
    same = grouping.create_groups(accounts, pairs, DEFAULTS.but(edge_gating=False)).collect()
    assert len({r.group_id for r in same}) == 1


@pytest.mark.parametrize("order", ["ascending", "descending"])
def test_ordered_replay_equals_components_without_the_bound(spark, order):
    rows = [(f"r{i:02d}", "acme " + "x" * (i % 3)) for i in range(30)]
    accounts = spark.createDataFrame(rows, "account_id string, name_core string")
    pairs = spark.createDataFrame([(f"r{i:02d}", f"r{(i * 7 + 3) % 30:02d}", 80 + i % 20) for i in range(30) if i != (i * 7 + 3) % 30], "id_a string, id_b string, score int")
    s = DEFAULTS.but(canopy_enabled=False, union_order=order)

    def parts(df):
        out = {}
        for r in df.collect():
            out.setdefault(r.group_id, set()).add(r.account_id)
        return sorted(map(sorted, out.values()))

    assert parts(grouping.create_groups(accounts, pairs, s)) == parts(grouping.create_groups(accounts, pairs, s, mode="ordered"))


def test_canopy_bounds_a_group(spark):
    accounts = spark.createDataFrame([(f"r{i:02d}", "acme") for i in range(20)], "account_id string, name_core string")
    pairs = spark.createDataFrame([("r00", f"r{i:02d}", 85) for i in range(1, 20)], "id_a string, id_b string, score int")
    got = grouping.create_groups(accounts, pairs, mode="ordered")
    assert max(r.group_size for r in got.collect()) == DEFAULTS.canopy_bound


def build(spark, edges, threshold, policy, ids="abcd", size=2):
    pairs = spark.createDataFrame(edges, "id_a string, id_b string, sim double")
    members = spark.createDataFrame([(i,) for i in ids], "id string")
    made = clusters.build_clusters(members, pairs, threshold, policy, size)
    out = {}
    for r in made.collect():
        out.setdefault(r.cluster_id, set()).add(r.id)
    return [out[k] for k in sorted(out)], {r.id for r in clusters.outliers(members, made).collect()}


def test_single_linkage(spark):
    assert build(spark, [("a", "b", 0.9), ("b", "c", 0.9), ("d", "a", 0.7)], 0.8, "single") == ([{"a", "b", "c"}], {"d"})


def test_complete_linkage(spark):
    assert build(spark, [("a", "b", 0.9), ("b", "c", 0.9), ("a", "c", 0.7)], 0.8, "complete", "abc") == ([{"a", "b"}], {"c"})
    assert build(spark, [("a", "b", 0.9), ("a", "z", 0.9)], 0.8, "complete", "ab") == ([{"a", "b"}], set())
    assert build(spark, [("a", "b", 0.9)], 0.8, "complete", "abc", 1) == ([{"a", "b"}, {"c"}], set())


@pytest.mark.parametrize("bad", [(1.5, "single", 2), (0.5, "other", 2), (0.5, "single", 0)])
def test_cluster_parameters(spark, bad):
    with pytest.raises(ValueError):
        build(spark, [("a", "b", 0.9)], bad[0], bad[1], "ab", bad[2])


def test_scores_of_known_names(spark):
    rows = normalise(synthetic_names(spark)).selectExpr("*", "cast(substring(account_id, 4) as int) as row_seq")
    scored = {(r.name_core_a, r.name_core_b, r.suffix_class_a == r.suffix_class_b): r for r in scoring.score_components(blocking.candidate_pairs(rows)).collect()}
    assert scored[("juniper quay ferry", "juniper quay ferrys", True)].score == 88
    assert scored[("juniper quay ferry", "juniper quay ferry", False)].score == 75
    assert all(0 <= r.score <= 100 for r in scored.values())


def test_large_blocks_are_sharded(spark):
    names = [("new " + w + " " + v) for w in ("york", "haven", "port") for v in ("one", "two", "three", "four")] * 3
    rows = spark.createDataFrame([(i, f"{i:03d}", n, "NONE") for i, n in enumerate(names)], "row_seq int, account_id string, name_core string, suffix_class string")
    s = DEFAULTS.but(block_cap=10)
    (r,) = blocking.block_stats(rows, s).collect()
    assert r.strategy == "standard_sharded" and r["count"] == 36 and r.pairs_generated == 12 * 3
    (r,) = blocking.block_stats(rows, s.but(deny_tokens=("new",), max_shard_size=5, max_candidates=1)).collect()
    assert r.strategy == "soft_ban_sharded" and r.pairs_generated == 12 * 2 and r.pairs_capped == 36 * 35 // 2 - 24
    with pytest.raises(ValueError):
        blocking.block_stats(rows, s.but(shard_strategy="third_token_initial"))


def test_disjoint_set():
    sets = grouping.DisjointSet()
    assert sets.union("a", "b") and not sets.union("b", "a") and sets.union("b", "c")
    sets.make_set("d")
    assert sets.get_size("a") == 3 and sets.get_set_count() == 2 and sets.get_set_members("c") == {"a", "b", "c"}


SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LARGER = os.path.join(os.path.dirname(SF), "sf0.01")


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no tables here")
def test_ordered_groups_against_a_replay_of_sets(spark):
    rows = queries.materialise(queries.unique(spark, LARGER))
    found = queries.materialise(queries.candidates(spark, LARGER))
    got = {}
    for r in grouping.create_groups(rows, found).collect():
        got.setdefault(r.group_id, set()).add(r.account_id)
    gated = [r for r in grouping.gate_edges(found, rows).collect() if r.accepted]
    groups, refused = {r.account_id: {r.account_id} for r in rows.select("account_id").collect()}, 0
    for e in sorted(gated, key=lambda e: (-e.score, e.id_a, e.id_b)):
        a, b = groups[min(e.id_a, e.id_b)], groups[max(e.id_a, e.id_b)]
        if a is b:
            continue
        if len(a) >= DEFAULTS.canopy_bound and e.score < DEFAULTS.high:
            refused += 1
            continue
        a |= b
        groups |= {x: a for x in b}
    assert sorted(map(sorted, got.values())) == sorted(map(list, {tuple(sorted(g)) for g in groups.values()}))
    assert refused and max(map(len, got.values())) >= DEFAULTS.canopy_bound


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no tables here")
def test_complete_clusters_against_a_search_of_all_members(spark):
    found = queries.materialise(queries.candidates(spark, LARGER, queries.NEAR))
    got = {}
    for r in clusters.clusters_of_run(found, 0.75, "complete")[0].collect():
        got.setdefault(r.cluster_id, []).append(r.id)
    rows = found.collect()
    near = {frozenset((r.id_a, r.id_b)) for r in rows if r.score >= 75}
    left, wanted = sorted({x for r in rows for x in (r.id_a, r.id_b)}), []
    while left:
        own = [left[0]]
        for x in left[1:]:
            if all(frozenset((x, y)) in near for y in own):
                own.append(x)
        if len(own) > 1:
            wanted.append(own)
        left = [x for x in left if x not in own]
    assert [sorted(got[n]) for n in sorted(got)] == wanted and sorted(got) == list(range(len(wanted)))
    assert any(len(x) > 2 for x in wanted)


def test_pairs_out_of_reach_have_no_score_that_counts(spark):
    names = ["acme trading", "acme trading 20", "acme trading co", "acme", "trading acme north", "beta works", "acme-trading", ""]
    rows = [(x, y, p, q) for x in names for y in names for p in ("LLC", "INC", None) for q in ("LLC", "INC")]
    pairs = spark.createDataFrame(rows, "name_core_a string, name_core_b string, suffix_class_a string, suffix_class_b string")
    scored = scoring.score_components(pairs.withColumn("near", scoring.within_reach()))
    told = [(r["near"], r["score"]) for r in scored.collect()]
    assert all(near for near, score in told if score >= DEFAULTS.medium)
    assert any(score >= DEFAULTS.medium for _, score in told) and any(not near for near, _ in told)


@pytest.mark.parametrize("most, overlap", [(None, 1), (None, 2), (1, 2), (3, 1), (50, 3)])
def test_pairs_of_soft_banned_shards_are_counted_without_being_made(spark, most, overlap):
    kinds = ["new york", "new york one", "new york one two", "new york o", "new", "new york zzzzzzzzzzzzzzzz qqqqqqqqqqqqqqq", "new haven x", "new haven y"]
    names = [kinds[(7 * i + i // 3) % len(kinds)] for i in range(60)]
    rows = spark.createDataFrame([(i // 2 if i > 50 else i, f"{i:03d}", n, "NONE") for i, n in enumerate(names)], "row_seq int, account_id string, name_core string, suffix_class string")
    s = DEFAULTS.but(block_cap=10, deny_tokens=("new",), max_shard_size=5, max_candidates=most, min_token_overlap=overlap, char_bigram_gate=0.3)
    made = blocking._pairs_with_blocks(blocking.blocks(rows, s), s).count()
    (r,) = blocking.block_stats(rows, s).collect()
    assert r.strategy == "soft_ban_sharded" and r.pairs_generated == made > 0


def test_block_stats_of_a_soft_banned_block_of_one_name(spark):
    rows = spark.range(60_000).selectExpr("cast(id as int) as row_seq", "'' || id as account_id", "if(id % 3 = 0, 'new york one', 'new york two') as name_core", "'NONE' as suffix_class")
    (r,) = blocking.block_stats(rows, DEFAULTS.but(deny_tokens=("new",))).collect()  # 1.8 billion pairs, were they made
    assert r.pairs_generated == 50 * 60_000 - 2 * (50 * 51 // 2)

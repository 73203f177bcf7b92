import json

import pytest
from pyspark.sql import functions as F

from accordant.config import DEFAULTS
from accordant.operators import alias, checks, disposition, serve, stats, survivorship
from accordant.functions.text import normalise
from accordant.plans.pipeline import ingest, resolve
from accordant.sources import schema, sinks, tables
from accordant.streaming.incremental import deduplicate_stream

GROUPS = [
    ("g1", "1", "Acme Inc", "INC", True, False, "W-2", 10, "2024-01-01", 0.0), ("g1", "2", "Acme LLC", "LLC", False, False, "W-2", 10, "2024-01-02", 95.0),
    ("g2", "3", "Beta", "NONE", False, False, "x", 60, None, 0.0), ("g2", "4", "Beta", "NONE", False, False, "x", 60, "2023-01-01", 90.0),
    ("g3", "5", "unknown thing", "NONE", True, False, "x", 60, "2024-01-01", 0.0), ("g4", "6", "dummy works", "NONE", True, False, "x", 60, "2024-01-01", 0.0),
    ("g5", "7", "Fine; Other", "NONE", True, True, "x", 60, "2024-01-01", 0.0), ("g6", "8", "Clean", "NONE", True, False, "x", 60, "2024-01-01", 0.0),
]
COLUMNS = "group_id string, account_id string, account_name string, suffix_class string, is_primary boolean, has_multiple_names boolean, relationship string, relationship_rank int, created_date string, weakest_edge_to_primary double"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(GROUPS, COLUMNS)


def test_primary_is_the_least_rank_then_date_then_id(rows):
    got = {r.account_id for r in survivorship.elect_primary(rows).where("is_primary").collect()}
    assert got == {"1", "4", "5", "6", "7", "8"}


def test_dispositions(spark, rows):
    placed = survivorship.elect_primary(rows)
    got = {r.account_id: (r.disposition, r.disposition_reason) for r in disposition.classify(placed).collect()}
    assert got == {
        "1": ("Verify", "suffix_mismatch"), "2": ("Verify", "suffix_mismatch"), "3": ("Update", "duplicate_record"), "4": ("Keep", "primary_record"),
        "5": ("Delete", "blacklisted_name"), "6": ("Verify", "suspicious_singleton"), "7": ("Verify", "multi_name_string_requires_split"), "8": ("Keep", "clean_singleton"),
    }
    forced = spark.createDataFrame([("5", "Keep")], "account_id string, override string")
    (r,) = disposition.classify(placed, overrides=forced).where("account_id = '5'").collect()
    assert (r.disposition, r.disposition_reason) == ("Keep", "manual_override:Keep")
    last = {r.account_id: r.disposition_reason for r in disposition.classify(placed, last_reason_wins=True).collect()}
    assert last["1"] == "primary_record" and last["7"] == "clean_singleton"


def test_previews_show_conflicts_only(rows):
    placed = survivorship.elect_primary(rows)
    got = {r.group_id: json.loads(r.merge_preview_json) for r in survivorship.merge_preview(placed, ["account_name", "suffix_class"]).collect()}
    assert set(got) == {"g1"}
    assert got["g1"]["primary_record"]["account_id"] == "1" and got["g1"]["field_comparisons"]["suffix_class"] == {"primary_value": "INC", "alternative_values": ["LLC"], "has_conflict": True}
    (r,) = survivorship.preview_summary(rows, ["account_name"]).collect()
    assert (r.conflicted, r.clean, r.total, r.rate) == (1, 1, 2, 0.5)


def test_pages_and_counts(rows):
    table = stats.group_stats(disposition.classify(survivorship.elect_primary(rows)))
    pages = [[r.group_id for r in serve.groups_page_from_stats(table, "Group Size (Desc)", p, 4).collect()] for p in (1, 2, 3)]
    assert pages == [["g1", "g2", "g3", "g4"], ["g5", "g6"], []]
    assert [r.group_id for r in serve.groups_page_from_stats(table, "no such key", 1, 2).collect()] == ["g1", "g2"]
    assert serve.count_groups(table, None, 90.0).first().groups == 2
    assert serve.count_groups(rows.selectExpr("*", "'Keep' as disposition"), ["Keep"], 95.0).first().groups == 1
    details = serve.details_page(rows, "g1", "Account Name (Desc)")
    assert [r.account_name for r in details.collect()] == ["Acme LLC", "Acme Inc"]


def test_parity_and_difference(rows):
    table = stats.group_stats(rows.selectExpr("*", "'x' as disposition"))
    assert all(r.differ == 0 and r.only_a == 0 for r in checks.parity(table, table).collect())
    assert checks.checksum(rows).first() == checks.checksum(rows.orderBy("account_name").repartition(3)).first()
    assert checks.difference(rows.limit(3), rows.limit(3)).count() == 0


def test_alias_matches(spark):
    names = [("1", "Acme Holdings; (2) Beta Tools"), ("2", "Beta Tools"), ("3", "Beta Tolls Group")]
    rows_ = normalise(spark.createDataFrame(names, "account_id string, account_name string"))
    groups = spark.createDataFrame([("2", "g2")], "account_id string, group_id string")
    (r,) = alias.alias_matches(rows_, groups).collect()
    assert (r.record_id, r.match_record_id, r.match_group_id, r.score) == ("1", "2", "g2", 100.0)


def test_headers(spark):
    df = spark.createDataFrame([("x", "001", "2024-01-01")], "`Company Name` string, Id string, `Create Date` string")
    mapping = schema.resolve_schema(df)
    assert mapping == {"account_name": "Company Name", "account_id": "Id", "created_date": "Create Date"}
    assert schema.require_columns(schema.apply_mapping(df, mapping)).columns == ["account_name", "account_id", "created_date"]
    odd = spark.createDataFrame([("x", "abcdefghijkl", "3/4/2024")], "customer_nm string, ref string, `when` string")
    assert schema.resolve_schema(odd, {"account_name": "customer_nm"}) == {"account_name": "customer_nm", "account_id": "ref", "created_date": "when"}
    with pytest.raises(ValueError):
        schema.resolve_schema(df, {"account_id": "missing"})


def test_csv_keeps_ids_as_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Id,Name,n,x\n0012,Acme,1,1.5\n0013,NaN,2,2\n")
    df = tables.read_csv_stable(spark, str(tmp_path / "a.csv"))
    assert dict(df.dtypes) == {"Id": "string", "Name": "string", "n": "bigint", "x": "double"}
    assert [tuple(r) for r in df.orderBy("Id").collect()] == [("0012", "Acme", 1, 1.5), ("0013", None, 2, 2.0)]


def test_audit_is_never_overwritten(spark, rows, tmp_path):
    first = sinks.write_audit(rows, str(tmp_path / "a"))
    assert sinks.write_audit(rows, str(tmp_path / "a"), "later") == first + "-later"
    sinks.write_export(survivorship.merge_preview(rows, ["account_name"]), str(tmp_path / "b"))


def test_whole_resolution_of_known_names(spark):
    raw = tables.synthetic_names(spark).selectExpr("*", "'Other/Miscellaneous' as relationship", "cast(substring(account_id, 4) as int) as row_seq")
    out = resolve(ingest(raw.unionByName(raw)))
    got = out.review.collect()
    assert len(got) == 32 and all(r.disposition for r in got)
    by = {}
    for r in got:
        by.setdefault(r.group_id, set()).add(r.account_name)
    assert {"Juniper Quay Ferry Inc", "Juniper Quay Ferry, Inc.", "Juniper Quay Ferrys Inc"} <= next(v for v in by.values() if "Juniper Quay Ferry Inc" in v)
    assert sum(r.is_primary for r in got) == len(by)


def test_a_stream_of_files(spark, tmp_path):
    for n, names in enumerate([["Acme Tools Inc", "Beta"], ["Acme Tools Inc.", "Gamma"]]):
        spark.createDataFrame([(f"{n}{i}", x) for i, x in enumerate(names)], "account_id string, account_name string").coalesce(1).write.json(str(tmp_path / "in" / str(n)))
        source = spark.readStream.schema("account_id string, account_name string").json(str(tmp_path / "in" / "*"))
        deduplicate_stream(source, str(tmp_path / "table"), str(tmp_path / "matches"), str(tmp_path / "checkpoint"), DEFAULTS).awaitTermination()
    assert [(r.id_a, r.id_b) for r in spark.read.parquet(str(tmp_path / "matches")).collect()] == [("10", "00")]


def test_no_cell_is_lost_to_its_columns_type(spark, tmp_path):
    lines = [f"{i},{i}" for i in range(21_000)] + ["21000,not a number", "99999999999999999999,7"]
    (tmp_path / "late.csv").write_text("n,m\n" + "\n".join(lines) + "\n")
    df = tables.read_csv_stable(spark, str(tmp_path / "late.csv"))
    assert dict(df.dtypes) == {"n": "string", "m": "string"} and df.where("n is null or m is null").count() == 0
    told = tables.read_csv_stable(spark, str(tmp_path / "late.csv"), {"n": "double", "m": "bigint"})
    assert dict(told.dtypes) == {"n": "double", "m": "string"} and told.where("m = 'not a number'").count() == 1


def test_settings_merge_key_by_key():
    s = tables.load_settings("high: 95\nranks: {Word of mouth: 12}\nstop_tokens: [inc]\n")
    assert s.high == 95 and s.stop_tokens == ("inc",) and s.ranks["Word of mouth"] == 12 and s.ranks["Company Name on W-2"] == 10
    with pytest.raises(TypeError):
        tables.load_settings("no_such_key: 1")


def test_all_exact_pairs_and_all_alias_matches_on_demand(spark):
    from accordant.operators import exact

    rows = spark.createDataFrame([(f"{i:02d}", "Same Name") for i in range(12)], "account_id string, account_name string")
    mapped = exact.exact_map(rows)
    assert [exact.exact_pairs(mapped, n).count() for n in (None, 12, 11)] == [66, 66, 11]
    records = normalise(spark.createDataFrame([("r", "Blue Kiln; Blue Kiln Works")] + [(f"m{i}", "Blue Kiln") for i in range(9)], "account_id string, account_name string"))
    ids = records.select("account_id", "account_id").toDF("account_id", "group_id")
    assert [alias.alias_matches(records, ids, DEFAULTS.but(max_alias_pairs=n)).count() for n in (None, 9, 4)] == [9, 9, 4]


def test_runs_resume_and_prune(spark, tmp_path):
    from accordant.plans import runs

    root, made = runs.Runs(spark, f"file://{tmp_path}/runs"), []

    def stage(name, fail=False):
        def f(df):
            made.append(name)
            if fail:
                raise RuntimeError("lost")
            return df.selectExpr("id + 1 as id")

        return name, f

    first = spark.range(3)
    name = runs.run_id("input", DEFAULTS, "20240101000000")
    with pytest.raises(RuntimeError):
        root.pipeline(name, [stage("a"), stage("b", fail=True)], first)
    assert root.latest() is None and root.orphans() == [name]
    assert sorted(r.id for r in root.pipeline(name, [stage("a"), stage("b")], first).collect()) == [2, 3, 4]
    assert made == ["a", "b", "b"]
    root.finish(name, rows=3)
    for day in (2, 3):
        other = runs.run_id("input", DEFAULTS, f"2024010{day}000000")
        root.pipeline(other, [stage("a")], first)
        root.finish(other, rows=3)
    assert root.latest() == other and [e["rows"] for e in root.index()] == [3, 3, 3] and root.size(name) > 0
    assert root.prune(2) == [name] and len(root.index()) == 2 and root.size(name) == 0 and root.orphans() == []


def test_parquet_reports_and_documents(spark, tmp_path, rows):
    sinks.write_stage(spark.range(1000).repartition(2), f"{tmp_path}/a")
    sinks.write_tuned(spark.range(1000).coalesce(1), f"{tmp_path}/b")
    report = sinks.parquet_report(spark, f"{tmp_path}/a").collect()
    assert len(report) == 2 and sum(r.rows for r in report) == 1000 and all(r.row_groups == 1 and r.codecs == "SNAPPY" for r in report)
    both = sinks.compare_tables(spark, f"{tmp_path}/a", f"{tmp_path}/b").first()
    assert (both.files_a, both.files_b, both.rows_a, both.rows_b) == (2, 1, 1000, 1000)
    matches = spark.createDataFrame([("semicolon",), ("semicolon",), ("parentheses",)], "alias_source string")
    snapshot = sinks.audit_snapshot(DEFAULTS, matches, "abc")
    assert snapshot["alias_matches"] == {"semicolon": 2, "parentheses": 1} and snapshot["thresholds"]["high"] == 92 and snapshot["config_hash"] == DEFAULTS.config_hash()
    sinks.write_document(spark, snapshot, f"{tmp_path}/audit")
    assert json.loads(spark.read.text(f"{tmp_path}/audit").first().value)["commit"] == "abc"


def test_content_hash_and_released_checkpoints(spark):
    from accordant.functions.text import content_hash
    from accordant.plans.materialise import materialise, release

    texts = ["a\r\nb\r\n\n", "a\nb", "a\rb  ", "a\n b"]
    got = [r.h for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", content_hash("t").alias("h")).orderBy("i").collect()]
    assert got[0] == got[1] == got[2] != got[3]
    df = materialise(spark.range(10))
    assert df.count() == 10
    path = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get()
    from accordant.plans.runs import exists

    assert exists(spark, path)
    release(df, spark.range(3))
    assert not exists(spark, path)


def test_counted_alias_matches_are_the_matches(spark):
    names = [("1", "Acme; Acme Works; Acme"), ("2", "Acme"), ("3", "Acme"), ("4", "Acme"), ("5", "Acme Works"), ("6", "Acme Works; Acme"), ("7", "Beta (Acme Works)")]
    records = normalise(spark.createDataFrame(names, "account_id string, account_name string"))
    groups = spark.createDataFrame([("2", "g"), ("3", "g"), ("4", "h"), ("1", "g"), ("6", "h")], "account_id string, group_id string")
    matches, counts = alias.alias_matches(records, groups), alias.alias_match_counts(records, groups)
    keys = ["record_id", "alias_text", "alias_source", "match_group_id", "score"]
    grouped = matches.groupBy(*keys).count()
    assert sorted(counts.select(*keys, "n").collect()) == sorted(grouped.collect())
    assert sorted(alias.cross_references(counts).collect()) == sorted(alias.cross_references(matches).collect())
    both = [alias.with_cross_references(records.select("account_id"), x).orderBy("account_id").collect() for x in (matches, counts)]
    assert both[0] == both[1] and any(not r.alias_cross_refs for r in both[0])


def test_alias_matches_of_names_that_many_records_hold(spark):
    told = spark.range(2_000).selectExpr("'a' || id as account_id", "'Acme Tools; Acme Group ' || id % 5 as account_name")
    records = normalise(told.unionByName(spark.range(2_000).selectExpr("'b' || id as account_id", "'Acme Tools' as account_name")))
    groups = records.select("account_id", F.lit("g").alias("group_id"))
    counts = alias.alias_match_counts(records, groups)  # 4 million matches, were they made
    assert counts.agg(F.count("*"), F.sum("n")).first() == (2_000, 4_000_000)

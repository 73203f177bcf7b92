"""A query for each operator of the inventory, named by its number there."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accordant import views
from accordant.config import DEFAULTS
from accordant.functions import text
from accordant.functions.fuzzy import token_ratios
from accordant.operators import alias, blocking, checks, clusters, disposition, exact, filters, grouping, scoring, serve, stats, survivorship
from accordant.plans.materialise import materialise

from accordant.plans.pipeline import FIELDS, ingest, resolve
from accordant.plans.shipping import ship

QUERIES = {}


def query(f):
    @wraps(f)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship(spark)
        return f(spark, sf)

    QUERIES[f.__name__] = run
    return run


def normalised(spark, sf):
    return text.normalise(views.accounts(spark, sf))


def kept(spark, sf):
    return filters.split_noise(normalised(spark, sf))[0]


def unique(spark, sf):
    """Written once, since blocks read it for both sides of their join and each of their counts."""
    rows = materialise(kept(spark, sf))
    return materialise(exact.unique_records(rows, exact.exact_map(rows)))


def candidates(spark, sf, settings=DEFAULTS):
    return scoring.scored_candidates(blocking.candidate_pairs(unique(spark, sf), only=scoring.within_reach(settings)), settings)


#: Clusters are asked for at a lower similarity than groups, so their candidates are kept from there on.
NEAR, SIMILAR = DEFAULTS.but(medium=60), 0.85

#: Groups that SQL can express: components, whatever their size.
UNBOUNDED = DEFAULTS.but(canopy_enabled=False)


def grouped(spark, sf):
    """Groups of all kept records, exact duplicates included."""
    rows = materialise(kept(spark, sf))
    mapped = exact.exact_map(rows)
    found = scoring.scored_candidates(blocking.candidate_pairs(exact.unique_records(rows, mapped), only=scoring.within_reach()))
    return grouping.create_groups(rows, materialise(found), UNBOUNDED, exact=exact.exact_star(mapped))


def survivors(spark, sf):
    ranked = survivorship.with_ranks(grouped(spark, sf), survivorship.rank_table(spark))
    return materialise(survivorship.elect_primary(ranked))


# Sources and projections


@query
def s4_parquet_projection(spark: SparkSession, sf: str) -> DataFrame:
    from accordant.sources.tables import read_columns

    return read_columns(spark, f"{sf}/customer.parquet", ["c_custkey", "missing", "c_mktsegment"])


@query
def p3_id_15_to_18(spark, sf):
    ids = spark.read.parquet(f"{sf}/part.parquet").selectExpr("p_partkey", "case when p_partkey % 2 = 0 then upper(substr(md5('' || p_partkey), 1, 15)) else substr(md5('' || p_partkey), 1, 15) end as id15")
    return ids.select("p_partkey", text.id_15_to_18("id15").alias("id18"), text.valid_id("id15").alias("valid"))


@query
def p5_dates(spark, sf):
    rows = spark.read.parquet(f"{sf}/part.parquet").selectExpr("p_partkey", "case when p_partkey % 3 = 0 then '' || (40000 + p_size) when p_partkey % 3 = 1 then '2024-02-' || lpad('' || (1 + p_size % 28), 2, '0') else 'no date' end as d")
    return rows.select("p_partkey", F.date_format(text.parse_date("d"), "yyyy-MM-dd").alias("parsed"))


@query
def p7_p8_normalise(spark, sf):
    return normalised(spark, sf).select("account_id", "name_base", "suffix_class", "name_core", "has_parentheses", "has_semicolon", "has_multiple_names", F.size("name_core_tokens").alias("n_tokens"))


@query
def p11_aliases(spark, sf):
    return normalised(spark, sf).select("account_id", F.explode("aliases").alias("x")).select("account_id", F.col("x.alias").alias("alias"), F.col("x.source").alias("source"))


@query
def p14_p15_enhanced_tokens(spark, sf):
    return normalised(spark, sf).select("account_id", F.array_join(F.array_sort(text.enhanced_tokens("name_core")), " ").alias("tokens"))


@query
def p16_p17_keys(spark, sf):
    return normalised(spark, sf).select("account_id", text.raw_exact_key("account_name").alias("raw_exact_key"), text.first_token_key("name_core", DEFAULTS.stop_tokens).alias("block_key"), text.bigram_key("name_core", ["red bolt", "hot gear"]).alias("bigram_key"))


# Filters


@query
def f1_f2_filtered_out(spark, sf):
    return filters.split_noise(normalised(spark, sf))[1]


@query
def a17_reject_reasons(spark, sf):
    return filters.reject_reasons(filters.split_noise(normalised(spark, sf))[1])


@query
def f7_f8_row_filters(spark, sf):
    return serve.filtered_rows(views.members(spark, sf), ["Keep", "Delete"], 40.0).select("group_id", "account_id", "disposition")


@query
def f10_min_group_size(spark, sf):
    return filters.min_group_size(views.members(spark, sf), 12).select("group_id", "account_id")


@query
def f11_suffix_mismatch(spark, sf):
    return filters.suffix_mismatch_only(views.members(spark, sf)).select("group_id", "account_id")


# Exact equals


@query
def a1_exact_groups(spark, sf):
    return exact.exact_groups(kept(spark, sf)).select("raw_exact_key", "representative_id", "group_size", F.array_join("all_account_ids", ",").alias("ids"))


@query
def c20_exact_map(spark, sf):
    return exact.exact_map(kept(spark, sf))


@query
def j8_unique_records(spark, sf):
    return unique(spark, sf).select("account_id", "account_name")


# Blocking and scoring


@query
def c9_block_stats(spark, sf):
    return blocking.block_stats(unique(spark, sf))


@query
def j1_candidate_pairs(spark, sf):
    return blocking.candidate_pairs(unique(spark, sf)).select("account_id_a", "account_id_b")


@query
def j3_sharded_pairs(spark, sf):
    """All records, so that blocks pass a lowered cap and are sharded."""
    s = DEFAULTS.but(block_cap=100, deny_tokens=("red", "the"), max_shard_size=20)
    return blocking.block_stats(kept(spark, sf), s)


@query
def a18_strategy_summary(spark, sf):
    return blocking.strategy_summary(blocking.block_stats(unique(spark, sf)))


@query
def a19_block_sizes(spark, sf):
    return blocking.size_distribution(blocking.block_stats(unique(spark, sf)), 60)


@query
def a25_brand_suggestions(spark, sf):
    return blocking.brand_suggestions(blocking.block_stats(unique(spark, sf)), 10, 0.5)


@query
def a26_allowlist_suggestions(spark, sf):
    return blocking.allowlist_suggestions(blocking.block_stats(unique(spark, sf)), 5)


@query
def c1_c2_token_ratios(spark, sf):
    nations = spark.read.parquet(f"{sf}/nation.parquet").select(text.name_core(text.name_base("n_name")).alias("core"))
    a, b = nations.select(F.col("core").alias("a")), nations.select(F.col("core").alias("b"))
    pairs = a.join(b, F.substring("a", 1, 6) == F.substring("b", 1, 6)).where("a < b").withColumn("r", token_ratios("a", "b"))
    return pairs.select("a", "b", F.round("r.ratio_name", 6).alias("ratio_name"), F.round("r.ratio_set", 6).alias("ratio_set"))


@query
def c4_scores(spark, sf):
    return scoring.score_components(blocking.candidate_pairs(unique(spark, sf))).select("account_id_a", "account_id_b", "score", "ratio_name", "ratio_set", F.round("jaccard", 6).alias("jaccard"), "num_style_match", "suffix_match")


@query
def f4_candidates(spark, sf):
    return candidates(spark, sf).select("id_a", "id_b", "score")


@query
def t1_candidate_order(spark, sf):
    return scoring.in_order(candidates(spark, sf)).limit(25).select("id_a", "id_b", "score")


@query
def c8_bulk_candidates(spark, sf):
    """At a lowered threshold, so that the gate leaves out pairs that would pass."""
    return scoring.bulk_candidates(blocking.candidate_pairs(unique(spark, sf)), DEFAULTS.but(medium=50)).select("id_a", "id_b", "score")


@query
def a13_top_blocks(spark, sf):
    return blocking.top_blocks(blocking.block_stats(unique(spark, sf)), 4)


@query
def v5_explained_block(spark, sf):
    return blocking.explain_token(unique(spark, sf), "red").select("block_key", "strategy", "shard", F.col("count").alias("records"))


@query
def j2_bigram_pairs(spark, sf):
    """With allow-listed bigrams that the names hold, and blocks beyond a lowered cap that are not sharded."""
    s = DEFAULTS.but(allow_bigrams=("red plate", "hot ring"), deny_tokens=("red", "hot"), block_cap=10, max_shard_size=5, min_token_overlap=3, max_candidates=None)
    return blocking.candidate_pairs(unique(spark, sf), s).select("account_id_a", "account_id_b")


@query
def c14_standard_groups(spark, sf):
    """Without gating every candidate is an edge."""
    rows = materialise(unique(spark, sf))
    made = grouping.create_groups(rows, materialise(candidates(spark, sf)), UNBOUNDED.but(edge_gating=False))
    return made.select("account_id", "group_size", F.min("account_id").over(_group()).alias("first_id"))


@query
def sql_functions(spark, sf):
    from accordant.functions import sql

    sql.register(spark)
    views.accounts(spark, sf).createOrReplaceTempView("accordant_accounts")
    return spark.sql("select account_id, normalize_name(account_name) as name_core, raw_exact_key(account_name) as raw_exact_key, round(token_sort_ratio(name_base(account_name), normalize_name(account_name)), 6) as ratio from accordant_accounts")


@query
def v9_content_hash(spark, sf):
    rows = views.accounts(spark, sf).select("account_id", F.concat("account_name", F.lit("\r\nsecond\r"), "relationship", F.lit(" \n\t\n")).alias("content"))
    return rows.select("account_id", text.content_hash("content").alias("content_hash"))


@query
def a15_candidate_stats(spark, sf):
    return scoring.candidate_stats(candidates(spark, sf))


# Groups


@query
def c11_gated_edges(spark, sf):
    return grouping.gate_edges(candidates(spark, sf), unique(spark, sf)).select("id_a", "id_b", "reason", "shared_tokens_count")


@query
def a27_gating_reasons(spark, sf):
    return grouping.gating_reasons(grouping.gate_edges(candidates(spark, sf), unique(spark, sf)))


@query
def c13_groups(spark, sf):
    return grouped(spark, sf).select("account_id", "group_size", "is_primary", F.min("account_id").over(_group()).alias("first_id"))


def _group():
    from pyspark.sql import Window

    return Window.partitionBy("group_id")


@query
def c12_ordered_groups(spark, sf):
    """The ordered replay with the canopy bound, which the order of unions decides; tests hold it against a replay of their own."""
    rows = materialise(unique(spark, sf))
    return grouping.create_groups(rows, materialise(candidates(spark, sf)), mode="ordered").select("account_id", "group_id", "group_size", "group_join_reason")


@query
def c16_group_ids(spark, sf):
    rows = views.members(spark, sf).groupBy("group_id").agg(F.collect_list("account_id").alias("m"))
    return rows.select("group_id", grouping.group_id("m", "0badcafe").alias("stable_id"))


@query
def c17_single_clusters(spark, sf):
    return clusters.clusters_of_run(materialise(candidates(spark, sf, NEAR)), SIMILAR, "single")[0].select("id", "cluster_id")


@query
def c18_complete_clusters(spark, sf):
    return clusters.clusters_of_run(materialise(candidates(spark, sf, NEAR)), SIMILAR, "complete")[0]


@query
def u5_outliers(spark, sf):
    return clusters.clusters_of_run(materialise(candidates(spark, sf, NEAR)), SIMILAR, "single")[1]


@query
def a22_cluster_stats(spark, sf):
    return clusters.cluster_stats(clusters.clusters_of_run(materialise(candidates(spark, sf, NEAR)), SIMILAR, "single")[0])


@query
def a23_cluster_min_similarity(spark, sf):
    found = materialise(candidates(spark, sf, NEAR))
    made = materialise(clusters.clusters_of_run(found, SIMILAR, "single")[0])
    return clusters.min_similarity(made, found.select("id_a", "id_b", (F.col("score") / 100).alias("sim")))


@query
def t8_cluster_page(spark, sf):
    found = materialise(candidates(spark, sf, NEAR))
    made, lone = clusters.clusters_of_run(found, SIMILAR, "single")
    made = materialise(made)
    names = unique(spark, sf).select(F.col("account_id").alias("id"), F.col("account_name").alias("name"))
    return clusters.cluster_page(made, clusters.min_similarity(made, found.select("id_a", "id_b", (F.col("score") / 100).alias("sim"))), names, lone, "size", 1, 10)


# Survivors, previews, dispositions


@query
def w1_survivors(spark, sf):
    return survivors(spark, sf).select("account_id", "relationship_rank", "is_primary")


@query
def a8_conflicts(spark, sf):
    rows = survivors(spark, sf).withColumn("first_id", F.min("account_id").over(_group()))
    return survivorship.group_conflicts(rows.drop("group_id").withColumnRenamed("first_id", "group_id"), FIELDS)


@query
def a9_merge_previews(spark, sf):
    return survivorship.merge_preview(survivors(spark, sf), FIELDS)


@query
def a10_preview_summary(spark, sf):
    return survivorship.preview_summary(views.members(spark, sf), ["account_name", "suffix_class"])


@query
def a20_group_quantiles(spark, sf):
    return survivorship.group_size_quantiles(views.members(spark, sf))


@query
def d4_dispositions(spark, sf):
    return disposition.classify(survivors(spark, sf)).select("account_id", "disposition", "disposition_reason")


@query
def d1_d3_blacklists(spark, sf):
    name = F.col("account_name")
    return views.accounts(spark, sf).select("account_id", disposition.blacklisted(name).alias("listed"), disposition.blacklisted_strictly(name, ["20-20"]).alias("strict"))


@query
def d7_last_reasons(spark, sf):
    return disposition.classify(survivors(spark, sf), last_reason_wins=True).select("account_id", "disposition", "disposition_reason")


@query
def d8_alias_reasons(spark, sf):
    """The reason that counts alias matches, over rows that have some."""
    rows = materialise(kept(spark, sf))
    found = alias.alias_match_counts(rows, rows.select("account_id", F.col("name_core").alias("group_id")))
    lone = rows.withColumns({"group_id": F.col("account_id"), "is_primary": F.lit(True), "has_multiple_names": F.lit(False)})
    return disposition.classify(alias.with_cross_references(lone, found), alias_details=True).select("account_id", "disposition", "disposition_reason")


@query
def a16_disposition_counts(spark, sf):
    return disposition.disposition_counts(disposition.classify(survivors(spark, sf)))


@query
def a7_group_metadata(spark, sf):
    rows = disposition.group_metadata(views.members(spark, sf))
    return rows.select("group_id", "group_size", F.array_join("suffix_classes", ",").alias("suffix_classes"), "has_suffix_mismatch", "blacklist_hits", "has_primary")


# Aliases


@query
def g1_alias_matches(spark, sf):
    rows = materialise(kept(spark, sf))
    return alias.alias_matches(rows, rows.select("account_id", F.col("name_core").alias("group_id"))).select("record_id", "alias_text", "alias_source", "match_record_id", "match_group_id", F.round("score", 6).alias("score"))


@query
def a24_cross_references(spark, sf):
    rows = materialise(kept(spark, sf))
    refs = alias.cross_references(alias.alias_match_counts(rows, rows.select("account_id", F.col("name_core").alias("group_id"))))
    return refs.select("account_id", F.size("alias_cross_refs").alias("n"), F.col("alias_cross_refs")[0]["alias"].alias("first_alias"))


# Statistics and serving


@query
def a2_group_stats(spark, sf):
    return stats.group_stats(views.members(spark, sf))


@query
def a3_group_stats_first(spark, sf):
    return stats.group_stats_first(views.members(spark, sf))


@query
def a12_size_histogram(spark, sf):
    return stats.size_histogram(views.members(spark, sf))


@query
def a21_in_group_scores(spark, sf):
    return stats.in_group_scores(materialise(candidates(spark, sf)).withColumn("score", F.col("score").cast("double")), unique(spark, sf).select("account_id", F.lit("all").alias("group_id")), "all")


@query
def t6_page_from_stats(spark, sf):
    return serve.groups_page_from_stats(stats.group_stats(views.members(spark, sf)), "Max Score (Desc)", 2, 20, ["Keep", "Update"], 50.0)


@query
def t6_page_from_rows(spark, sf):
    return serve.groups_page_from_rows(views.members(spark, sf), "Group Size (Desc)", 1, 25, ["Keep"], 20.0)


@query
def t7_details_page(spark, sf):
    return serve.details_page(serve.group_details(views.members(spark, sf)), "7", "Account Name (Desc)", 1, 10)


@query
def a6_count_groups(spark, sf):
    rows = views.members(spark, sf)
    a = serve.count_groups(rows, ["Keep"], 30.0).withColumn("source", F.lit("rows"))
    return a.unionByName(serve.count_groups(stats.group_stats(rows), ["Keep"], 30.0).withColumn("source", F.lit("stats")))


@query
def a29_badges(spark, sf):
    return serve.badges(views.members(spark, sf).withColumn("account_name", F.concat_ws(" ", "account_name", F.when(F.col("account_id").cast("long") % 7 == 0, "sample"))))


@query
def j14_refreshed_stats(spark, sf):
    rows = views.members(spark, sf)
    return stats.refresh_dispositions(stats.group_stats(rows.withColumn("disposition", F.lit("Update"))), rows)


@query
def w4_keep_first(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "user_id", "event_type")
    return stats.keep_first(events, "user_id", "event_id")


@query
def a28_newest_runs(spark, sf):
    return stats.newest_runs(views.runs(spark, sf)).select("run_id", "input_hash", "config_hash")


@query
def t9_latest_runs(spark, sf):
    return stats.latest(views.runs(spark, sf), 10).select("run_id")


# Checks


@query
def j7_dangling_references(spark, sf):
    rows = unique(spark, sf)
    return scoring.check_references(candidates(spark, sf), rows.where("row_seq % 10 <> 0"))


@query
def v1_parity(spark, sf):
    rows = views.members(spark, sf)
    a = stats.group_stats(rows)
    return checks.parity(a, stats.group_stats(rows.where("account_id <> '17'")))


@query
def u4_difference(spark, sf):
    rows = views.members(spark, sf).select("group_id", "disposition")
    return checks.difference(rows.where("disposition <> 'Keep'"), rows.where("disposition <> 'Delete'")).groupBy("side", "disposition").agg(F.count("*").alias("n"))


@query
def v3_checksum(spark, sf):
    return checks.checksum(views.members(spark, sf))


@query
def whole_resolution(spark, sf):
    """Every stage from raw accounts to the review table."""
    review = resolve(ingest(views.accounts(spark, sf)), UNBOUNDED).review
    return review.select("account_id", "account_name", "group_id", "group_size", "is_primary", "disposition", "disposition_reason", F.to_json("alias_cross_refs").alias("alias_cross_refs"))

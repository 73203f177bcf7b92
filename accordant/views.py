"""The driver's tables in the roles that the operators work on, as SQL that any engine reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from accordant.plans.shipping import ship

ACCOUNTS = """
select '001' || lpad('' || p_partkey, 12, '0') as account_id, p_partkey as row_seq,
  case when p_partkey % 97 = 5 then 'unknown' when p_partkey % 101 = 7 then '1099' when p_partkey % 103 = 9 then '???'
       when p_partkey % 8 = 0 then p_name || ' Inc' when p_partkey % 8 = 1 then upper(p_name) || ', L.L.C.'
       when p_partkey % 8 = 2 then p_name || ' & Sons  Ltd.' when p_partkey % 8 = 3 then p_name || ' (Acme Supply Corp)'
       when p_partkey % 8 = 4 then '(1)' || p_name || '; (2) ' || p_name || ' Sons Limited' when p_partkey % 8 = 5 then 'The ' || p_name || ' Company'
       when p_partkey % 32 = 6 then p_name || '; ' || p_name || ' works' when p_partkey % 32 = 14 then p_name || ' global trading partners'
       when p_partkey % 32 = 30 then p_name || ' global trading partner' when p_partkey % 8 = 6 then p_name || ' 20-20' else p_name end as account_name,
  case when p_size % 3 = 0 then 'Company Name on W-2' when p_size % 3 = 1 then 'Company Logo on Emails' else 'Word of mouth' end as relationship,
  '2024-01-' || lpad('' || (1 + p_size % 28), 2, '0') as created_date
from part
"""

MEMBERS = """
select '' || o_custkey as group_id, '' || o_orderkey as account_id, o_orderpriority as account_name, o_totalprice / 5000 as weakest_edge_to_primary,
  o_orderkey = min(o_orderkey) over (partition by o_custkey) as is_primary,
  case when o_orderstatus = 'F' then 'Delete' when o_orderstatus = 'O' then 'Keep' else 'Update' end as disposition,
  case when o_orderkey % 5 = 0 then 'LLC' else 'INC' end as suffix_class, o_orderdate as created_date
from orders
"""

RUNS = """
select event_id as run_id, user_id as input_hash, event_type as config_hash, ts as "timestamp" from events
"""


def view(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    """A view's SQL over the tables it names."""
    ship(spark)
    text = sql.replace('"', "`")
    args = {}
    for t in tables:
        args[t] = spark.read.parquet(f"{sf_dir}/{t}.parquet")
        text = text.replace(f"from {t}\n", f"from {{{t}}}\n").replace(f"from {t} ", f"from {{{t}}} ")
    return spark.sql(text, **args)


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, ACCOUNTS, "part")


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, MEMBERS, "orders")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, RUNS.strip() + "\n", "events")

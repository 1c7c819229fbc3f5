"""Z-rows: streaming."""

from __future__ import annotations

from framewise.operators.ordering import top_k
from framewise.plans.registry import register
from framewise.session import scratch_path
from framewise.sources.tables import table
from framewise.streaming.running_counts import running_counts


@register("stream_running_counts", sql="""
SELECT l_partkey, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY count DESC, l_partkey LIMIT 100""")
def q_stream_running_counts(spark, d):
    base = scratch_path(spark, "stream")
    src = table(spark, d, "lineitem", ["l_orderkey", "l_partkey"])
    src.write.parquet(f"{base}/in")   # several files arrive in the folder
    counts = running_counts(spark, f"{base}/in", src.schema, "l_partkey", f"{base}/counts", f"{base}/ckpt")
    return top_k(counts, "count", 100, ["l_partkey"])

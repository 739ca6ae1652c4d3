"""Time the headline queries: prints one JSON line.

The derived skeleton and synapse tables are landed first and reported as
``prepare``; every query then runs once, its whole result consumed.
"""

from __future__ import annotations

import json
import os
import time

HEADLINE = (
    "child_counts", "retype_type0", "type0_file_summary", "long_child_screen", "soma_status", "adaptive_branch_removal", "soma_repair_log",
    "branch_order", "root_distance", "subtree_cable", "parent_first_order", "soma_proximal_branches", "deflection_angle",
    "nearest_node", "synapse_log", "distance_summary", "neuropil_order_counts", "zero_filled_stats", "js_similarity_pairs",
    "relink_multifurcations", "soma_prune_log", "edge_samples", "mesh_center_distance", "point_in_mesh", "minhash_signature", "voxel_jaccard_topk",
)


def main() -> None:
    from pyspark.sql import SparkSession

    from arborspark.plans import forest
    from arborspark.plans.catalog import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "16g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    started = time.time()
    forest.forest(spark, folder).count()
    forest.synapses(spark, folder).count()
    seconds = {"prepare": round(time.time() - started, 3)}
    for name in HEADLINE:
        started = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()

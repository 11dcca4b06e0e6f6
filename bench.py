"""Times the headline queries; prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

HEADLINE = ["speaker_lexical", "lexical_core", "mattr", "discourse_markers", "temporal_markers", "turn_taking", "nearest_speaker", "interval_lines", "norms_lookup", "phrase_spans", "stats_long", "dup_groups", "deid_shift", "redact_labels", "coherence", "word_graph", "deid_notes", "record_lookup", "recording_names", "ttr_ways", "capitals", "fuzzy_match", "overlap_speakers", "graph_clustering"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from voxloom.plans import catalog, files_and_deid, queries, tiers_and_joins  # noqa: F401

    found = catalog.queries()
    run = lambda q: found[q](spark, sf_dir).write.format("noop").mode("overwrite").save()
    run("speaker_views")  # warm-up
    took = {}
    for q in HEADLINE:
        t = time.time()
        run(q)
        took[q] = round(time.time() - t, 3)
    print(json.dumps({"metric": "headline queries, wall seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Wall time of the registered queries.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS``; prints one JSON line.
``BENCH_QUERIES`` may name queries (comma separated) or be ``all``. Every query is run once to
warm the code paths and then timed; results are computed in full and discarded.
"""

from __future__ import annotations

import json
import os
import sys
import time

from lumenframe.plans import catalogue
from lumenframe.session import local_session

HEADLINE = (
    "coadd_ivar clean_spectra join_arms spectrum_snr signal_noise continuum_robust cosmic_ray_mask fill_gaps sky_valley_mask "
    "line_indices overlap_rebin interp_at band_join broaden_variable ivar_balance select_targets best_repeat first_class_rank outer_merge "
    "attach_scan broadcast_bin_values target_summary_join xmatch_sky overlap_weights nearest_bin provenance_leaves weighted_curves bin_curves "
    "arc_outliers fibre_clean grid_bin lambda_r adaptive_flux_filter cube_block_bin rank_best inject_class fallback_redshift "
    "refine_minimum survey_class matched_filter connected_voxels dedupe_candidates candidate_vetoes promote_candidates split_patches manifest_diff"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(catalogue.QUERIES) if asked == "all" else [n for n in asked.split(",") if n] or HEADLINE
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in names:
        run = catalogue.QUERIES[name]
        for last in (False, True):
            spark.catalog.clearCache()
            start = time.perf_counter()
            run(spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
        times[name] = round(took, 3)
        print(f"{name} {took:.2f}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_wall", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Benchmark the headline queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints ONE JSON line.  Every query is fully evaluated through the ``noop``
sink (no driver collect); the time includes planning and any model fit.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kiln.plans import registry  # noqa: E402
from kiln.session import get_spark  # noqa: E402

HEADLINE = [
    "q_nb_predict_lang",   # J4: long-form NB fit + predict
    "q_nb_binary",         # J1: per-line binary NB
    "q_nb_ngram",          # J3: 3+4-gram NB
    "q_tfidf",             # FEA-7
    "q_ngrams_34",         # FEA-4/8 term statistics
    "q_confusion_pivot",   # EVA-2
    "q_html_clean",        # TXT-8..16 on pages
    "q_wiki_clean",        # TXT-1..18 on generated wiki text
    "q_wet_roundtrip",     # SRC-5 write + read
    "q_dump_pages",        # SRC-8 wiki XML dump read
    "q_ml_multiclass",     # MOD-5 (b) MLlib pipeline
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", app="kiln-bench",
                      shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", int(cpus) * 2)),
                      conf={"spark.driver.memory": "16g"})
    qs = registry.queries()
    names = [n for n in HEADLINE if n in qs]
    if len(sys.argv) > 1:
        names = sys.argv[1:]
    # warm-up: JVM, parquet footer cache, codegen cache
    qs[names[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(sf)
    except ValueError:
        pass
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()

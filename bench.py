"""Benchmark: index build, compression and batch search over the whole
``documents`` table of one scale factor.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Every timed step is forced with the ``noop`` sink or a real Parquet write.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from invdex.operators import compress as C  # noqa: E402
from invdex.operators import index as X  # noqa: E402
from invdex.operators import search as S  # noqa: E402
from invdex.plans import workloads as W  # noqa: E402
from invdex.session import build_session, scratch_path, stored as kept  # noqa: E402
from invdex.sources import index_store as IO  # noqa: E402
from invdex.sources.corpus import documents_corpus  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build_session(master=f"local[{cpus}]", app="invdex-bench", shuffle_partitions=max(8, cpus))
    times: dict[str, float] = {}

    # Untimed JVM warm-up (class loading, code generation) on the smallest
    # scale factor, so the timed steps measure the engine, not the JIT.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    warm_s = None
    if os.path.isdir(warm_dir) and warm_dir != sf_dir:
        t0 = time.time()
        wix = X.build_index(documents_corpus(spark, warm_dir))
        _run(S.search(wix.postings, wix.word_dict, wix.doc_dict, W.dev_queries(spark)))
        _run(C.decode_vb(C.encode(C.segments(wix.postings))))
        warm_s = round(time.time() - t0, 3)

    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        return out

    root = scratch_path(spark, "bench-index")
    corpus = documents_corpus(spark, sf_dir)

    def build():
        ix = X.build_index(corpus)
        IO.write_index(ix, root)

    timed("index_build", build)
    stored = IO.read_index(spark, root)

    timed("compress_vb_gamma", lambda: IO.write_compressed(C.encode(C.segments(stored.postings)), root))
    enc = IO.read_compressed(spark, root)
    timed("vb_decode_all", lambda: _run(C.decode_vb(enc)))
    timed("gamma_decode_all", lambda: _run(C.decode_gamma(enc)))
    timed("block_postings", lambda: _run(X.block_postings(stored.postings, stored.doc_dict)))
    # even and odd documents: every longer list is on both sides
    halves = [kept(X.segment_lists(stored.postings.where(f"did % 2 = {k}")), f"bench-half-{k}") for k in (0, 1)]
    timed("merge_blocks", lambda: _run(X.merge_blocks(*halves)))
    timed("index_size", lambda: C.index_size(stored.postings, enc).collect())

    def search(queries):
        def go():
            _run(S.search(stored.postings, stored.word_dict, stored.doc_dict, queries, seek=True, order=stored.name_order))
        return go

    timed("search_dev", search(W.dev_queries(spark)))
    timed("search_benchmark", search(W.benchmark_queries(spark, sf_dir)))
    timed("search_conversations", search(W.conversation_queries(spark, sf_dir)))

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_time", "value": total, "unit": "sec", "queries": times, "sf": sf,
                      "cpus": cpus, "warmup_sec_untimed": warm_s}))
    spark.stop()


if __name__ == "__main__":
    main()

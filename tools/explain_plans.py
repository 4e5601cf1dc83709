"""Print the formatted physical plans of the main jobs (build, codecs,
stored search) for review. usage: python tools/explain_plans.py [sf_dir]"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from invdex.operators import compress as C  # noqa: E402
from invdex.operators import index as X  # noqa: E402
from invdex.operators import search as S  # noqa: E402
from invdex.plans import workloads as W  # noqa: E402
from invdex.session import build_session, scratch_path  # noqa: E402
from invdex.sources import index_store as IO  # noqa: E402
from invdex.sources.corpus import documents_corpus  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    ix = X.build_index(documents_corpus(spark, sf_dir))
    root = scratch_path(spark, "explain")
    IO.write_index(ix, root)
    st = IO.read_index(spark, root)
    plans = {
        "documents under provisional keys": X.doc_terms(X.keyed_terms(ix.corpus)),
        "occurrences": X.occurrences(ix.corpus, ix.doc_dict, ix.word_dict),
        "postings (salted token -> term_id join)": ix.postings,
        "segments with gap bases": C.segments(st.postings),
        "encode VB + gamma": C.encode(C.segments(st.postings)),
    }
    q = W.dev_queries(spark)
    lk = S.term_lookup(S.parse_queries(q), st.word_dict, seek=True).persist()
    plans["stored search: batch postings (seek)"] = S._batch_postings(st.postings, lk, True, True)
    plans["stored search: hits"] = S.conjunctive_hits(st.postings, lk, seek=True, small=True)
    for title, df in plans.items():
        print(f"\n===== {title}")
        df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()

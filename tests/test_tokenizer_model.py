"""Random byte corpora against a direct model: tokens equal bytes.split()
(which splits on exactly the six ASCII whitespace bytes), doc ids follow
(block, file) byte order, across more blocks than partitions."""

import random

from pyspark.sql import functions as F

from corpus_helpers import write_corpus
from invdex.operators import index as X
from invdex.sources.corpus import read_directory

ALPHABET = [b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r", b"\x85", b"\xa0", b"\x1c", b"a", b"b", b"c", b",",
            b"?", b"\xff", b"\xc3\xa9", b"  "]


def test_random_corpus_matches_model(spark, tmp_path):
    rnd = random.Random(11)
    files = {}
    for i in range(40):
        block = f"b{rnd.randint(0, 11):02d}" + rnd.choice(["", "-x", "_y"])
        name = rnd.choice(["f", "_f", ".f", "f-g", "F"]) + str(rnd.randint(0, 99))
        files[f"{block}/{name}"] = b"".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 60)))
    root = write_corpus(str(tmp_path / "c"), files)
    corpus = read_directory(spark, root)
    ix = X.build_index(corpus)
    expected_order = sorted(files, key=lambda k: tuple(p.encode() for p in k.split("/")))
    got_order = [r.doc_name for r in ix.doc_dict.orderBy("did").collect()]
    assert got_order == expected_order
    toks = (X.token_positions(ix.corpus, ix.doc_dict).join(ix.doc_dict.select("did", "doc_name"), "did")
            .groupBy("doc_name").agg(F.sort_array(F.collect_list(F.struct("pos", "token"))).alias("t"))
            .collect())
    got = {r.doc_name: [x.token.encode("latin-1") for x in r.t] for r in toks}
    for name, data in files.items():
        assert got.get(name, []) == data.split(), name

"""Codec vectors (FIXTURES.md section 2) and round trips, incl. long gaps."""

import random

import pytest
from pyspark.sql import functions as F

from invdex.functions.codecs import (bits_to_hex, gamma_bits, gamma_bits_number, gamma_decode_ids, gamma_pad,
                                     gaps_array, ungap_array, vb_decode_ids, vb_hex, vb_hex_number)
from invdex.operators import compress as C

# Number -> VB hex, gamma bits (None: undefined for 0).
VECTORS = [
    (0, "80", None),
    (1, "81", "0"),
    (2, "82", "100"),
    (3, "83", "101"),
    (4, "84", "11000"),
    (127, "ff", "1111110111111"),
    (128, "0180", "111111100000000"),
    (129, "0181", "111111100000001"),
    (16383, "7fff", "111111111111101111111111111"),
    (16384, "010080", "11111111111111000000000000000"),
    (2097151, "7f7fff", "1" * 20 + "0" + "1" * 20),
    (2097152, "01000080", "1" * 21 + "0" + "0" * 21),
    (268435455, "7f7f7fff", "1" * 27 + "0" + "1" * 27),
    (268435456, "0100000080", "1" * 28 + "0" + "0" * 28),
    (214577, "0d0cb1", "11111111111111111010100011000110001"),
]


def _vb_py(n):
    out = [n % 128]
    while n >= 128:
        n //= 128
        out.insert(0, n % 128)
    out[-1] += 128
    return bytes(out).hex()


def test_vectors(spark):
    df = spark.createDataFrame([(n,) for n, _, _ in VECTORS], "n bigint")
    got = {r.n: (r.vb, r.g) for r in df.select("n", vb_hex_number(F.col("n")).alias("vb"),
                                               gamma_bits_number(F.col("n")).alias("g")).collect()}
    for n, vb, g in VECTORS:
        assert got[n][0] == vb, n
        if g is not None:
            assert got[n][1] == g, n


def test_vb_beyond_five_digits(spark):
    nums = [2 ** 35 - 1, 2 ** 35, 2 ** 49 + 7, 2 ** 56, 2 ** 62 + 12345, 2 ** 63 - 1]
    df = spark.createDataFrame([(n,) for n in nums], "n bigint")
    got = {r.n: r.vb for r in df.select("n", vb_hex_number(F.col("n")).alias("vb")).collect()}
    assert got == {n: _vb_py(n) for n in nums}


def test_gamma_packing_pad_in_front(spark):
    # gaps 1,1,1,2,1 -> 0 0 0 100 0 = 7 bits, one zero in front -> 0x08
    df = spark.createDataFrame([([1, 1, 1, 2, 1],)], "g array<bigint>")
    r = df.select(gamma_bits("g").alias("b")).select("b", gamma_pad("b").alias("p")) \
        .select("b", "p", bits_to_hex("b", "p").alias("h")).first()
    assert (r.b, r.p, r.h) == ("0001000", 1, "08")


@pytest.mark.parametrize("seed", [1, 2])
def test_round_trip_random_lists(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for t in range(40):
        n = rnd.randint(1, 60)
        ids = sorted(rnd.sample(range(1, 10 ** rnd.randint(2, 12)), n))
        base = rnd.choice([0, ids[0] - 1]) if ids[0] > 1 else 0
        rows.append((t, base, ids))
    df = spark.createDataFrame(rows, "t bigint, base bigint, ids array<bigint>")
    g = df.withColumn("gaps", gaps_array("ids", "base"))
    g = g.withColumn("vb", F.unhex(vb_hex("gaps"))).withColumn("bits", gamma_bits("gaps")) \
        .withColumn("pad", gamma_pad("bits").cast("int")).withColumn("gm", F.unhex(bits_to_hex("bits", "pad")))
    out = g.select("t", "ids", ungap_array("gaps", "base").alias("u"),
                   vb_decode_ids("vb", "base").alias("v"),
                   gamma_decode_ids("gm", "pad", "base").alias("m")).collect()
    for r in out:
        assert list(r.u) == list(r.ids)
        assert list(r.v) == list(r.ids)
        assert list(r.m) == list(r.ids)


def test_segment_bases_two_levels(spark):
    """Small segment width and fanout force both lag levels; VB bytes of the
    segments joined in order equal the whole-list bytes."""
    rnd = random.Random(7)
    rows = []
    for t in range(5):
        ids = sorted(rnd.sample(range(1, 3000), rnd.randint(1, 900)))
        rows += [(t, d) for d in ids]
    post = spark.createDataFrame(rows, "term_id bigint, did bigint")
    segs = C.segments(post, seg_width=8, fanout=3)
    enc = C.encode(segs).collect()
    by_term = {}
    for r in sorted(enc, key=lambda r: (r.term_id, r.seg)):
        by_term.setdefault(r.term_id, []).append(bytes(r.vb).hex())
    for t in range(5):
        ids = sorted(d for tt, d in rows if tt == t)
        gaps = [b - a for a, b in zip([0] + ids[:-1], ids)]
        assert "".join(by_term[t]) == "".join(_vb_py(g) for g in gaps)
    back = sorted((r.term_id, r.did) for r in C.decode_vb(C.encode(segs)).collect())
    assert back == sorted(rows)
    back_g = sorted((r.term_id, r.did) for r in C.decode_gamma(C.encode(segs)).collect())
    assert back_g == sorted(rows)

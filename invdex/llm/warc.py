"""WARC archives with an index (operator 9).

Writing: every page becomes one WARC record, a gzip member of its own, in files
that tasks write under the shared folder; each task returns index rows (file,
offset, length, url, digest ...), and only index rows of finished tasks count,
so files of lost attempts are never read. Of records with equal payloads of at
least ``MIN_BYTES`` bytes, the one with the smallest page_id carries the payload
(``response``); the others are ``revisit`` records that refer to it.

Reading: index first. The selected records are sorted by file and offset, dealt
out by file and 8 MB stretch, and neighbouring byte ranges are coalesced into
single reads.

Equal payloads are found in a narrow table (digest, page_id, url, rows, bytes),
aggregated before its shuffle. Revisit records need no html and are made from that
table alone; of the pages themselves the scan leaves out those the table names, whose
set is broadcast after a size check, or else joined with salt. So an html is written by
the task that reads it; only pages that stand there twice with one id, url and
payload are merged (one row per task before the shuffle).

Defined cases: null html is an empty payload (all pages without payload are
equal); a null page_id sorts last and is null again when read; two rows with the
same smallest page_id and payload are one response and one revisit; null urls
are written without a target; other columns are ignored; an empty table gives
an empty index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import is_small, salted_join
from ..session import scratch_path
from .common import prepare, table, written

MIN_BYTES = 0
FILE_BYTES = 512 << 20   # a task starts a new file beyond this size
READ_BYTES = 8 << 20     # most bytes read at once (one longer record: its own read)
GAP_BYTES = 64 << 10     # gaps up to this size are read over
NO_ID = 2**63 - 1
COPIES = 1 << 16         # most rows one task makes of a repeated one
DATE = "2000-01-01T00:00:00Z"  # fixed, so that archives are reproducible

INDEX = "path string, offset bigint, length bigint, page_id bigint, url string, digest string, payload_bytes bigint, record_type string"
RECORD = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def _urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _record(page_id, url, payload: bytes, size: int, digest: str, first) -> bytes:
    """One uncompressed record; ``first`` is the response's id for revisits, which
    give the ``size`` of a payload they don't hold."""
    kind = "response" if first is False else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = [("WARC-Type", kind), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    head.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if kind == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _urn(first))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def _parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC headers, HTTP headers, payload) of one record."""
    def headers(raw: bytes) -> dict[str, str]:
        return {k.decode().lower(): v.strip().decode() for k, _, v in (x.partition(b":") for x in raw.split(b"\r\n")[1:])}

    head, _, rest = data.partition(b"\r\n\r\n")
    warc = headers(head)
    http, _, payload = rest[:int(warc["content-length"])].partition(b"\r\n\r\n")
    return warc, headers(http), payload


def _writer(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(root)
        out, path, at = None, "", 0
        for b in batches:
            index: dict[str, list] = {k.split()[0]: [] for k in INDEX.split(", ")}
            for r in b.to_pylist():
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    path = f"{root}/{name}"
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                payload, size = (r["html"] or "").encode(), r["bytes"]
                digest = base64.b32encode(bytes.fromhex(r["sha1"])).decode()
                first = False if r["response"] else (None if r["first"] == NO_ID else r["first"])
                member = gzip.compress(_record(r["page_id"], r["url"], payload, size, digest, first), 5, mtime=0)
                out.write(member)
                for k, v in (("path", path), ("offset", at), ("length", len(member)), ("page_id", r["page_id"]), ("url", r["url"]),
                             ("digest", digest), ("payload_bytes", size), ("record_type", "response" if r["response"] else "revisit")):
                    index[k].append(v)
                at += len(member)
            yield pa.RecordBatch.from_pydict(index, schema=pa.schema([
                (k, pa.int64() if t == "bigint" else pa.string()) for k, t in (x.split() for x in INDEX.split(", "))]))
        if out is not None:
            out.close()

    return run


def write(pages: DataFrame, root: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write the archives below ``root``; returns their index (written)."""
    prepare(pages.sparkSession)
    p = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumns({"sha1": F.sha1("html"), "bytes": F.octet_length("html"), "id": F.coalesce("page_id", F.lit(NO_ID)),
                       "none": F.col("page_id").isNull()})
    pairs = written(p.filter(F.col("bytes") >= min_bytes).groupBy("sha1", "id", "none", "url", "page_id")
                    .agg(F.count(F.lit(1)).alias("n"), F.max("bytes").alias("bytes")), "warc-pairs")
    shared = (pairs.groupBy("sha1").agg(F.min(F.struct("id", "none", "url")).alias("first"), F.sum("n").alias("rows"))
              .filter("rows > 1"))
    known = pairs.join(F.broadcast(shared), "sha1") if is_small(shared) else salted_join(pairs, shared, "sha1", "rows", "id")
    known = written(known.withColumn("leads", F.struct("id", "none", "url") == F.col("first")), "warc-copies")
    # revisits, from the narrow table; a row that stands for many is dealt out in two steps
    more = known.withColumn("again", F.col("n") - F.col("leads").cast("int")).filter("again > 0")
    more = (more.withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("again") - 1) / COPIES)))).repartition("sha1", "id", "k")
            .withColumn("j", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(COPIES), F.col("again") - F.col("k") * COPIES)))))
    revisits = more.select("page_id", "url", F.lit(None).cast("string").alias("html"), "sha1", "bytes", F.col("first.id").alias("first"),
                           F.lit(False).alias("response"))
    # responses: the pages without those named, and one of each leading row that stands there twice
    named = known.filter("NOT leads OR n > 1").select(F.struct("sha1", "id", "none", "url").alias("key"), "leads", "n")
    keyed = p.withColumn("key", F.struct("sha1", "id", "none", "url"))
    met = keyed.join(F.broadcast(named), "key", "left") if is_small(named) else salted_join(keyed, named, "key", "n", "bytes", how="left")
    cols = ["page_id", "url", "html", "sha1", "bytes", F.lit(None).cast("bigint").alias("first"), F.lit(True).alias("response")]
    rows = met.filter("n IS NULL").select(*cols).unionByName(revisits)
    if not named.filter("leads").isEmpty():
        rows = rows.unionByName(met.filter("leads").dropDuplicates(["sha1", "id", "none", "url"]).select(*cols))
    store, base = _open(root)
    store.create_dir(base, recursive=True)
    index = rows.mapInArrow(_writer(root), INDEX)
    return written(index, "warc-index")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of sorted index rows, through coalesced reads."""
    names = [x.split()[0] for x in RECORD.split(", ")]
    schema = pa.schema([(k, pa.int64() if t == "bigint" else pa.string()) for k, t in (x.split() for x in RECORD.split(", "))])
    store, handle, opened = None, None, None

    def number(urn: str | None):
        digits = (urn or "")[len("<urn:page:"):-1]
        return int(digits) if digits else None

    def read(run):
        nonlocal store, handle, opened
        path, start, end = run[0][0], run[0][1], max(o + n for _, o, n in run)
        if path != opened:
            store, inner = _open(path)
            handle, opened = store.open_input_file(inner), path
        data = handle.read_at(end - start, start)
        made = {k: [] for k in names}
        for _, o, n in run:
            warc, http, payload = _parse(gzip.decompress(data[o - start:o - start + n]))
            kind = warc["warc-type"]
            size, digest = int(http["content-length"]), warc["warc-payload-digest"].partition(":")[2]
            if kind == "response":
                size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
            for k, v in zip(names, (number(warc["warc-record-id"]), warc.get("warc-target-uri"), size, digest, kind,
                                    number(warc["warc-refers-to"]) if kind == "revisit" else None)):
                made[k].append(v)
        return pa.RecordBatch.from_pydict(made, schema=schema)

    run: list[tuple[str, int, int]] = []
    for b in batches:
        for path, offset, length in zip(*(b.column(k).to_pylist() for k in ("path", "offset", "length"))):
            if run and (run[-1][0] != path or offset - run[-1][1] - run[-1][2] > GAP_BYTES or offset + length - run[0][1] > READ_BYTES):
                yield read(run)
                run = []
            run.append((path, offset, length))
    if run:
        yield read(run)


def read(index: DataFrame) -> DataFrame:
    """The records that ``index`` rows (a whole index, or a filtered one) name."""
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stretch = index.select("path", "offset", "length", F.floor(F.col("offset") / READ_BYTES).alias("stretch"))
    return (stretch.repartition(n, "path", "stretch").sortWithinPartitions("path", "offset").drop("stretch")
            .mapInArrow(_reader, RECORD))


def q_op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages archived, and all records read back through the index."""
    prepare(spark)
    index = write(table(spark, sf_dir, "pages").select("page_id", "url", "html"), scratch_path(spark, "warc"))
    return read(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS s FROM pages),
f AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY page_id) AS k, min(page_id) OVER (PARTITION BY s) AS first FROM p),
b AS (SELECT *, array_to_string([lpad(bin(strpos('0123456789abcdef', s[i]) - 1), 4, '0') for i in range(1, 41)], '') AS bits FROM f)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + 16 * CAST(bits[5 * j + 1] AS INT) + 8 * CAST(bits[5 * j + 2] AS INT) + 4 * CAST(bits[5 * j + 3] AS INT) + 2 * CAST(bits[5 * j + 4] AS INT) + CAST(bits[5 * j + 5] AS INT) AS INT), 1) for j in range(0, 32)], '') AS payload_digest,
  CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k = 1 THEN NULL ELSE first END AS refers_to
FROM b
"""

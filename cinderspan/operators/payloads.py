"""Payloads and releases before they are read: signatures, lengths, checksums, safe names, what a manifest must say."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspan.operators import records
from cinderspan.operators.spread_model import leak_columns

# The first bytes of classic (three versions) and HDF5-based files, in hex.
SIGNATURES = ("43444601", "43444602", "43444605", "894844460D0A1A0A")
#: Bytes of a file that are held at once.
PIECE = 8 << 20


def payload_facts(df: DataFrame, payload: str = "payload", algorithm: str = "checksum_algorithm") -> DataFrame:
    """``df`` with ``head`` (hex of the first eight bytes), ``n_bytes`` and ``digest`` (hex, by each row's algorithm; null for an unknown one) of a binary column."""
    c, name = F.col(payload), F.upper(F.regexp_replace(F.col(algorithm), "[-_]", ""))
    digest = F.when(name == "MD5", F.md5(c)).when(name == "SHA1", F.sha1(c))
    for bits in (224, 256, 384, 512):
        digest = digest.when(name == f"SHA{bits}", F.sha2(c, bits))
    return df.withColumns({"head": F.hex(F.substring(c, 1, 8)), "n_bytes": F.octet_length(c).cast("bigint"), "digest": digest})


def file_facts(spark: SparkSession, folder: str, algorithm: str = "sha256", pattern: str = "*") -> DataFrame:
    """``name, n_bytes, head, digest`` of a folder's files of any size: Spark lists them without their contents, tasks read them piece by piece.

    Spark's listing passes over files without a byte, so a release that names one finds it missing.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder).select("path", F.col("length").alias("n_bytes"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            heads, digests = [], []
            for path in batch["path"]:
                system, root = fs.FileSystem.from_uri(path)
                found, head = hashlib.new(algorithm), b""
                with system.open_input_stream(root) as stream:
                    while piece := stream.read(PIECE):
                        head = head or piece[:8]
                        found.update(piece)
                heads.append(head.hex().upper())
                digests.append(found.hexdigest())
            yield batch.assign(head=heads, digest=digests)

    held = files.repartition(max(1, spark.sparkContext.defaultParallelism)).mapInPandas(work, "path string, n_bytes long, head string, digest string")
    return held.select(F.substring_index("path", f"/{folder.rstrip('/').rpartition('/')[2]}/", -1).alias("name"), "n_bytes", "head", "digest")


def payload_fault(status: str = "status_code", length: str = "content_length", encoding: str = "content_encoding", algorithm: str = "checksum_algorithm", checksum: str = "checksum") -> Column:
    """The first fault of an answer whose facts are known (``payload_facts``), or null: status, signature, length (where the transport didn't encode it), checksum."""
    signed = F.lit(False)
    for s in SIGNATURES:
        signed = signed | F.startswith(F.col("head"), F.lit(s))
    stated = F.col(length).isNotNull() & (F.coalesce(F.col(encoding), F.lit("")) == "")
    number = F.expr(f"try_cast(trim({length}) as bigint)")
    summed = (F.coalesce(F.col(algorithm), F.lit("")) != "") & (F.coalesce(F.col(checksum), F.lit("")) != "")
    return (
        F.when(~F.coalesce(F.col(status).between(200, 299), F.lit(False)), F.concat(F.lit("HTTP "), F.coalesce(F.col(status).cast("string"), F.lit("none"))))
        .when(~F.coalesce(signed, F.lit(False)), "signature")
        .when(stated & number.isNull(), "invalid-length")
        .when(stated & (number != F.col("n_bytes")), "length")
        .when(summed & F.col("digest").isNull(), "unknown-algorithm")
        .when(summed & (F.lower("digest") != F.lower(F.col(checksum))), "checksum")
    )


def name_faults(listed: DataFrame, name: str = "name") -> DataFrame:
    """Listed names that a release may not have: blank, absolute, leading out of the folder, with backslashes or empty parts, or listed twice."""
    n = F.col(name)
    parts = F.split(n, "/")
    fault = (
        F.when(F.coalesce(F.trim(n), F.lit("")) == "", "blank")
        .when(n.startswith("/") | n.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), "absolute")
        .when(F.contains(n, F.lit("\\")), "backslash")
        .when(F.array_contains(parts, "..") | F.array_contains(parts, "."), "leads-out")
        .when(F.array_contains(parts, ""), "empty-part")
    )
    rows = listed.groupBy(name).agg(F.count("*").alias("_n"))
    return rows.select(name, F.coalesce(fault, F.when(F.col("_n") > 1, "repeated")).alias("fault")).where("fault is not null")


def release_faults(manifests: DataFrame, columns: list[str], n_rows: int, kind: str = "candidate-release", versions: tuple[int, ...] = (2,)) -> DataFrame:
    """``build_id, rule`` that a release's manifest breaks, given its table's header and number of rows.

    ``manifests`` has ``build_id, kind, schema_version, start_on, end_on, weather_available, features, n_rows``. Features must be in the header, each once, and none may leak.
    """
    header = F.array(*map(F.lit, columns))
    leaks = F.array(*map(F.lit, leak_columns(columns))).cast("array<string>")
    rules = {
        "kind": F.col("kind") == kind,
        "schema version": F.col("schema_version").isin(*versions),
        "dates in order": F.col("start_on") <= F.col("end_on"),
        "no weather": ~F.col("weather_available"),
        "features are named once": (F.size("features") > 0) & (F.size(F.array_distinct("features")) == F.size("features")),
        "features are in the header": F.size(F.array_except("features", header)) == 0,
        "features don't leak": F.size(F.array_intersect("features", leaks)) == 0,
        "header names columns once": F.lit(len(set(columns)) == len(columns)),
        "rows": F.col("n_rows") == n_rows,
    }
    return records.violations(manifests, rules, ["build_id"])

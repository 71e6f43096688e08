"""Files that other programs make: networks and endgame tables, found and checked by their headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: First bytes of outcome and distance tables.
MAGIC = {"rtbw": bytes([0x71, 0xE8, 0x23, 0x5D]), "rtbz": bytes([0xD7, 0x66, 0x0C, 0xA5])}


def table_files(spark: SparkSession, paths: str, separator: str = ":") -> DataFrame:
    """path, material, kind, length and sound of the table files in the folders of a separated list; up to seven men."""
    found = None
    for path in filter(None, paths.split(separator)):
        part = spark.read.format("binaryFile").option("pathGlobFilter", "*.rtb[wz]").load(path)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "path string, material string, kind string, length long, sound boolean")
    name = F.regexp_extract("path", r"([^/]+)\.(rtb[wz])$", 1)
    kind = F.regexp_extract("path", r"\.(rtb[wz])$", 1)
    head = F.hex(F.substring("content", 1, 4))
    sound = F.lit(False)
    for k, magic in MAGIC.items():
        sound = sound | ((kind == k) & (head == magic.hex().upper()))
    return found.select("path", name.alias("material"), kind.alias("kind"), "length", (sound & (F.col("length") % 64 == 16)).alias("sound")).where(F.length(F.replace("material", F.lit("v"), F.lit(""))) <= 7)


def network_file(spark: SparkSession, name: str, folders: list[str]) -> bytes:
    """The first file of that name in the folders; FileNotFoundError if there is none, so nothing runs without a network."""
    for folder in folders:
        rows = spark.read.format("binaryFile").option("pathGlobFilter", name).load(folder).select("content").take(1)
        if rows:
            return bytes(rows[0]["content"])
    raise FileNotFoundError(f"no network {name} in {folders}")

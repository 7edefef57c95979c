"""Sources and sinks: inventories, fingerprints, strict JSON, libraries of definitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partloom.plans.rules import framed


def file_inventory(spark: SparkSession, root: str, suffixes: Sequence[str], name_contains: str = "", exclude: str = "mask") -> DataFrame:
    """(path, name, size, modified) of files below a folder with one of the suffixes; names that hold ``exclude`` are left out. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = F.element_at(F.split("path", "/"), -1)
    kept = files.select("path", name.alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    low = F.lower("name")
    kept = kept.where(low.rlike("(" + "|".join(s.lower().replace(".", "[.]") for s in suffixes) + ")$"))
    kept = kept.where(~low.contains(exclude)) if exclude else kept
    return kept.where(low.contains(name_contains.lower())) if name_contains else kept


def fingerprint(columns: Sequence[str]) -> Column:
    """SHA-256 of the columns' texts, in order of name, each after its length."""
    return F.sha2(framed(sorted(columns)), 256)


def read_contract(df: DataFrame, text_col: str, schema: T.StructType, required: Sequence[str]) -> DataFrame:
    """Strict JSON: parsed columns, and the reasons why a text is refused (not JSON, missing fields, unknown fields)."""
    parsed = df.withColumn("__j", F.from_json(text_col, schema, {"mode": "PERMISSIVE"}))
    broken = F.col("__j").isNull() | ~F.trim(text_col).rlike(r"^\{.*\}$")
    names = F.json_object_keys(text_col)
    unknown = F.size(F.array_except(F.coalesce(names, F.array().cast("array<string>")), F.array(*[F.lit(f.name) for f in schema.fields]))) > 0
    why = F.array_compact(F.array(F.when(broken, F.lit("not_json")), *[F.when(~broken & F.col(f"__j.{r}").isNull(), F.lit(f"missing_{r}")) for r in required], F.when(~broken & unknown, F.lit("unknown_field"))))
    return parsed.select(*df.columns, *[F.col(f"__j.{f.name}").alias(f.name) for f in schema.fields], F.array_join(why, ",").alias("reason_codes"))


def scan_library(modules: DataFrame) -> DataFrame:
    """One row for each exported definition of module texts (path, text): name, display name, description, keywords. Comments are masked first."""
    bare = F.regexp_replace(F.regexp_replace("text", r"(?s)/\*.*?\*/", " "), r"//[^\n]*", " ")
    defs = modules.select("path", F.explode(F.regexp_extract_all(bare, F.lit(r"(?s)export\s+material\s+\w+\s*\(.*?(?=export\s+material|\z)"), F.lit(0))).alias("body"))
    text = lambda a: F.nullif(F.regexp_extract("body", rf'{a}\(\s*"([^"]*)"', 1), F.lit(""))
    name = F.regexp_extract("body", r"export\s+material\s+(\w+)", 1)
    words = F.regexp_extract_all(F.regexp_extract("body", r"key_words\(\s*string\[\]\(([^)]*)\)", 1), F.lit('"([^"]*)"'), F.lit(1))
    return defs.select("path", name.alias("name"), F.concat(F.lit("mdl:"), "path", F.lit("#"), name).alias("material_id"), text("display_name").alias("display_name"), text("description").alias("description"), F.array_join(F.array_sort(words), ",").alias("keywords"))


def extract_profiles(definitions: DataFrame, text_col: str = "body") -> DataFrame:
    """Numbers and flags of definition texts: base colour, roughness, metallic, and whether a texture is set."""
    number = lambda n: F.expr(f"try_cast(regexp_extract({text_col}, '{n}\\\\s*[:=]\\\\s*([0-9.]+)f?', 1) as double)")
    colour = [F.expr(f"try_cast(regexp_extract({text_col}, 'color\\\\(\\\\s*([0-9.]+)f?\\\\s*,\\\\s*([0-9.]+)f?\\\\s*,\\\\s*([0-9.]+)', {i}) as double)") for i in (1, 2, 3)]
    return definitions.select("*", *[c.alias(n) for c, n in zip(colour, "rgb", strict=True)], number("roughness").alias("roughness"), number("metallic").alias("metallic"), F.col(text_col).rlike(r"texture_2d\(\s*\"").alias("textured"))


def attach_preview(catalog: DataFrame, files: DataFrame, module: str, export: str) -> DataFrame:
    """The preview of the export, else of its module. files: (name, path), the name without its suffix."""
    one = files.select(F.col("name").alias("__n1"), F.col("path").alias("__own"))
    two = files.select(F.col("name").alias("__n2"), F.col("path").alias("__module"))
    out = catalog.join(one, F.col("__n1") == F.concat_ws(".", module, export), "left").join(two, F.col("__n2") == F.col(module), "left")
    return out.select(*catalog.columns, F.coalesce("__own", "__module").alias("preview"))


def pixel_table(images: DataFrame, step: int = 1) -> DataFrame:
    """(image, x, y, r, g, b) of decoded images (image, width, height, channels in BGR order, data), each ``step``-th pixel of each ``step``-th row. Images are cut into rows first, and rows into pixels."""
    wide = F.col("width") * F.col("channels")
    rows = images.select("image", "width", "channels", "data", F.explode(F.expr(f"sequence(0, height - 1, {step})")).alias("y"))
    rows = rows.select("image", "width", "channels", "y", F.substring("data", F.col("y") * wide + 1, wide).alias("line"))
    cells = rows.select("image", "y", "channels", "line", F.explode(F.expr(f"sequence(0, width - 1, {step})")).alias("x"))
    byte = lambda i: F.conv(F.hex(F.substring("line", F.col("x") * F.col("channels") + i, F.lit(1))), 16, 10).cast("int")
    return cells.select("image", "x", "y", byte(3).alias("r"), byte(2).alias("g"), byte(1).alias("b"))


def decode_part_ids(pixels: DataFrame, parts: DataFrame) -> DataFrame:
    """Pixels (r, g, b) of a part-coloured image to parts; the colour of a part is its number as 24 bits."""
    packed = F.shiftleft("r", 16).bitwiseOR(F.shiftleft("g", 8)).bitwiseOR(F.col("b"))
    return pixels.withColumn("__c", packed).join(parts.select("part_id", F.col("colour").alias("__c")), "__c", "left").drop("__c")


def build_manifest(results: DataFrame, reports: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each asset: number of deliveries, worst quality and the sorted distinct limitations (a set of fixed codes)."""
    d = results.groupBy(*keys).agg(F.count(F.lit(1)).alias("deliveries"))
    r = reports.groupBy(*keys).agg(F.min("quality").alias("worst_quality"), F.array_join(F.array_sort(F.collect_set("limitation")), ",").alias("limitations"))
    return d.join(r, list(keys), "left").select(*keys, "deliveries", "worst_quality", F.coalesce("limitations", F.lit("")).alias("limitations"))


def export_allowlist(catalog: DataFrame, key: str) -> DataFrame:
    """Distinct entries with how often each occurs."""
    return catalog.groupBy(key).agg(F.count(F.lit(1)).alias("entries"))

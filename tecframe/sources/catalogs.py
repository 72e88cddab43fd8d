"""Station and file catalogs out of listings and web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def extract_links(pages: DataFrame, *, html: str = "html", suffix: str | None = None,
                  ignore_case: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Distinct link targets of the pages, optionally those with one suffix."""
    found = pages.select(*keep, F.explode(F.regexp_extract_all(html, F.lit('href="([^"]*)"'), 1)).alias("link"))
    if suffix:
        text = F.lower("link") if ignore_case else F.col("link")
        found = found.filter(text.endswith(suffix.lower() if ignore_case else suffix))
    return found.distinct()


def parse_station_json(docs: DataFrame, *, column: str = "json") -> DataFrame:
    """Stations of a JSON array: code, sampling interval."""
    schema = "array<struct<cod_estacion:string,intervalo_observacion:string>>"
    rows = docs.select(F.explode(F.from_json(column, schema)).alias("s"))
    code = F.lower("s.cod_estacion")
    return rows.select(
        F.upper(code).alias("station_id"), F.substring(code, 1, 4).alias("station_code4"),
        F.col("s.intervalo_observacion").cast("int").alias("sampling_sec"),
    )


def parse_file_list(docs: DataFrame, yy: str, *, column: str = "text") -> DataFrame:
    """Distinct station codes of a file list: first word of each line after the first."""
    lines = docs.select(F.explode(F.slice(F.split(column, r"\r?\n"), 2, 2**31 - 1)).alias("line"))
    path = F.get(F.split(F.trim("line"), r"\s+"), F.lit(0))
    return (
        lines.select(path.alias("p"))
        .filter(F.col("p").endswith(f".{yy}d.gz"))
        .select(F.lower(F.get(F.split("p", "/"), F.lit(3))).alias("station_code4"))
        .filter(F.col("station_code4").isNotNull())
        .distinct()
    )


def _folder(depth: int) -> str:
    """Schema of a container of placemarks with so many levels of containers inside."""
    point = "struct<coordinates:string>"
    marks = f"Placemark:array<struct<name:string,Point:{point},MultiGeometry:struct<Point:array<{point}>>>>"
    inner = f",Folder:array<{_folder(depth - 1)}>,Document:array<{_folder(depth - 1)}>" if depth else ""
    return f"struct<{marks}{inner}>"


def parse_placemarks(docs: DataFrame, *, column: str = "kml", depth: int = 4) -> DataFrame:
    """Named points of a map file; marks without a name or three coordinates drop out.

    The files are read by Spark's XML parser: prefixes, entities and CDATA count
    as XML has them. Folders may be ``depth`` levels deep. A document that is not
    XML has no points.
    """
    options = {"ignoreNamespace": "true", "mode": "PERMISSIVE"}
    level = docs.select(F.array(F.from_xml(column, _folder(depth), options)).alias("c"))
    marks = None
    for d in range(depth + 1):
        level = level.select(F.explode("c").alias("c"))
        here = level.select(F.explode("c.Placemark").alias("m")).select("m.name", F.coalesce("m.Point.coordinates", F.get("m.MultiGeometry.Point.coordinates", F.lit(0))).alias("xyz"))
        marks = here if marks is None else marks.union(here)
        if d < depth:
            none = F.array().cast(f"array<{_folder(depth - d - 1)}>")
            level = level.select(F.concat(F.coalesce("c.Folder", none), F.coalesce("c.Document", none)).alias("c"))
    name, xyz = F.trim("name"), F.split(F.trim("xyz"), ",")
    number = lambda i: F.get(xyz, F.lit(i)).try_cast("double")
    return (
        marks.select(
            F.upper(name).alias("station_id"), F.lower(F.substring(name, 1, 4)).alias("station_code4"),
            number(1).alias("lat"), number(0).alias("lon"), number(2).alias("height_m"),
        )
        .filter((F.col("station_id") != "") & F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("height_m").isNotNull())
    )


def sanitise_paths(df: DataFrame) -> DataFrame:
    """Absolute paths of another machine become empty in every ``*_path`` column."""
    from tecframe.functions.text import relative_path

    names = [c for c in df.columns if c.endswith("_path")]
    return df.withColumns({c: relative_path(c) for c in names}) if names else df

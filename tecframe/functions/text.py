"""Names, labels and identifiers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tecframe import fixed
from tecframe.functions._col import ColumnLike, col, let
from tecframe.functions.timefn import day_of_year, gps_day_of_week, gps_week, year2


def file_name(path: ColumnLike) -> Column:
    return F.regexp_extract(col(path), r"([^/]*)$", 1)


def file_stem(path: ColumnLike) -> Column:
    """Name without its last suffix; a leading dot is no suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def asset_id(path: ColumnLike) -> Column:
    return F.concat(file_stem(path), F.lit("-"), F.substring(F.md5(col(path)), 1, 12))


def parse_observation_name(
    path: ColumnLike, *, default_sampling: int, overrides: dict[str, str] | None = None
) -> Column:
    """Struct (station_id, station_code4, sampling_sec); NULL for other names."""
    name = file_name(path)
    long_id = F.upper(F.regexp_extract(name, fixed.OBS_LONG_NAME, 1))
    is_long = long_id != ""
    short_code = F.upper(F.regexp_extract(name, fixed.OBS_SHORT_NAME, 1))
    code = F.when(is_long, F.substring(long_id, 1, 4)).otherwise(short_code)
    station = F.when(is_long, long_id).otherwise(short_code)
    if overrides:
        table = F.create_map(*[F.lit(x) for kv in overrides.items() for x in kv])
        station = F.coalesce(F.element_at(table, code), station)
    sampling = F.when(
        is_long, F.nullif(F.regexp_extract(name, fixed.OBS_LONG_NAME, 2), F.lit("")).cast("int")
    ).otherwise(F.lit(default_sampling))
    return F.when(
        code != "",
        F.struct(
            station.alias("station_id"),
            code.alias("station_code4"),
            sampling.alias("sampling_sec"),
        ),
    )


def parse_swath_name(member: ColumnLike) -> Column:
    """Struct (hemisphere, obs_time); NULL for other names."""
    # the fields of a match have fixed widths
    hit = F.regexp_extract(col(member), fixed.SWATH_NAME, 0)

    def fields(h: Column) -> Column:
        stamp = F.try_to_timestamp(F.substring(h, 18, 14), F.lit("yyyy_DDD_HH_mm"))
        return let(stamp, lambda t: F.when(
            t.isNotNull(), F.struct(F.substring(h, 10, 3).alias("hemisphere"), t.alias("obs_time"))
        ))

    return let(hit, lambda h: F.when(h != "", fields(h)))


def parse_omni_name(path: ColumnLike) -> Column:
    """Struct (kind, start, end) of an index file; NULL for other names."""
    name = file_name(path)
    prefix = F.lower(F.regexp_extract(name, fixed.OMNI_NAME, 1))
    kind = (
        F.when(F.contains(prefix, F.lit("bz_1min")), F.lit("bz"))
        .when(F.contains(prefix, F.lit("dst_kp_hourly")), F.lit("hourly"))
        .when(F.contains(prefix, F.lit("kp_3hour")), F.lit("kp"))
    )
    day = lambda i: F.try_to_timestamp(
        F.regexp_extract(name, fixed.OMNI_NAME, i), F.lit("yyyyMMdd")
    )
    end = day(3) + F.expr("INTERVAL '86399' SECOND")
    return F.when(kind.isNotNull(), F.struct(kind.alias("kind"), day(2).alias("start"), end.alias("end")))


def fill_template(
    template: ColumnLike, *, day: ColumnLike, station: ColumnLike | None = None
) -> Column:
    """Replaces date and station fields of a path template; nothing is fetched."""
    fields = {
        "yyyy": F.date_format(col(day), "yyyy"),
        "year": F.date_format(col(day), "yyyy"),
        "ddd": day_of_year(day),
        "doy": day_of_year(day),
        "yy": year2(day),
        "gps_week": gps_week(day).cast("string"),
        "dow": gps_day_of_week(day).cast("string"),
    }
    if station is not None:
        fields["station"] = F.lower(col(station))
    out = col(template)
    for name, value in fields.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return out


def pair_title(cha: ColumnLike, chb: ColumnLike, mid: ColumnLike) -> Column:
    head = F.date_format(col(mid), "yyyy-MM-dd HH:mm'UT'")
    both = F.concat(
        head, F.lit("  |  CHA "), F.date_format(col(cha), "HH:mm"),
        F.lit(" + CHB "), F.date_format(col(chb), "HH:mm"),
    )
    return F.when(col(cha) == col(chb), head).otherwise(both)


def pair_file_name(cha: ColumnLike, chb: ColumnLike, mid: ColumnLike, target_nm: float) -> Column:
    return F.concat(
        F.date_format(col(mid), "yyyyMMdd'T'HHmm'Z'"),
        F.lit("_CHA-"), F.date_format(col(cha), "HHmm"),
        F.lit("_CHB-"), F.date_format(col(chb), "HHmm"),
        F.lit("_" + str(target_nm).replace(".", "p") + "nm.png"),
    )


def series_file_name(
    start: ColumnLike, end: ColumnLike, station: ColumnLike, satellites: ColumnLike
) -> Column:
    fmt = "yyyyMMdd'T'HHmmss"
    return F.concat_ws(
        "_",
        F.date_format(col(start), fmt), F.date_format(col(end), fmt), F.upper(col(station)),
        F.array_join(F.transform(col(satellites), lambda s: F.lower(s)), "_"),
        F.lit("timeseries"),
    )


def panel_label(index: ColumnLike, station: ColumnLike, sv: ColumnLike, metric: str) -> Column:
    """(a) STATION SV METRIC, lettered by slot."""
    letter = F.char((col(index) + 97).cast("bigint"))
    return F.concat(F.lit("("), letter, F.lit(") "), F.concat_ws(" ", col(station), col(sv), F.lit(metric)))


def threshold_label(metric: str, threshold: float, count: ColumnLike) -> Column:
    # fixed values: unit texts
    units = {"vtec": "TECU", "roti": "10^16 el/m^2/min"}
    unit = units.get(metric.lower(), "")
    head = f"{metric.upper()} > {threshold:.1f}" + (f" {unit}" if unit else "")
    return F.concat(F.lit(head + " (n="), col(count).cast("string"), F.lit(")"))


def status_error(obs_status: ColumnLike, nav_status: ColumnLike) -> Column:
    return F.concat(
        F.lit("obs_status="), F.coalesce(col(obs_status), F.lit("")),
        F.lit("; nav_status="), F.coalesce(col(nav_status), F.lit("")),
    )


def is_retryable(error: ColumnLike) -> Column:
    """Any of the fixed error texts occurs."""
    found = F.lit(False)
    for marker in fixed.RETRY_MARKERS:
        found = found | F.contains(col(error), F.lit(marker))
    return F.coalesce(found, F.lit(False))


def relative_path(path: ColumnLike) -> Column:
    """Absolute or missing paths become empty."""
    p = col(path)
    return F.when(p.isNull() | p.startswith("/"), F.lit("")).otherwise(p)


def code4(station: ColumnLike) -> Column:
    return F.upper(F.substring(F.trim(col(station)), 1, 4))

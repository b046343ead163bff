"""Mixed timestamp formats and time zones (problem 6).

An ordered cascade of anchored patterns, the first match deciding, rewrites a
stamp into its fields; the fields are checked strictly and put on the time line
by, in this order, the offset in the stamp, the zone abbreviation of the
source's zone, or the source's clock.  All of it stays in the JVM.

Policy for local times: of a time that the clock shows twice the earlier
instant holds; a time that it skips is read as if the clock had not yet been
moved; a mere date is its midnight.  Null, blank, relative and impossible
stamps, and zone-less ones without a source, name no instant (null).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_T = r"(\d{1,2}):(\d{2})"
_OFF = r"(Z|[+-]\d{2}:?\d{2})"
_ABBR = r"([A-Z]{2,5}|[+-]\d{2})"
_CN_AM, _CN_PM = "上午|凌晨|早上|AM|am", "下午|晚上|中午|PM|pm"


@dataclass(frozen=True)
class Pattern:
    """``regex`` is anchored; ``to`` rewrites it to ``y|mo|d|h|mi|s|frac|half|zone`` ($n are its groups); ``order`` limits it to locales: M month first, D day first."""

    regex: str
    to: str
    order: str = ""


CASCADE = (
    Pattern(rf"^(\d{{4}})-(\d{{2}})-(\d{{2}})[T ]{_T}(?::(\d{{2}})(?:[.,](\d{{1,9}}))?)?\s*{_OFF}$", "$1|$2|$3|$4|$5|$6|$7||$8"),
    Pattern(rf"^(\d{{4}})-(\d{{2}})-(\d{{2}})[T ]{_T}(?::(\d{{2}})(?:[.,](\d{{1,9}}))?)?$", "$1|$2|$3|$4|$5|$6|$7||"),
    Pattern(rf"^(\d{{4}})-(\d{{2}})-(\d{{2}})[T ]{_T}(?::(\d{{2}}))?\s*(?:UTC|GMT)\s*([+-]\d{{1,2}}(?::?\d{{2}})?)$", "$1|$2|$3|$4|$5|$6|||$7"),
    Pattern(rf"^(\d{{4}})-(\d{{2}})-(\d{{2}})[T ]{_T}(?::(\d{{2}}))?\s+{_ABBR}$", "$1|$2|$3|$4|$5|$6|||@$7"),
    Pattern(r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})$", "$1|$2|$3||||||"),
    Pattern(rf"^(\d{{4}})/(\d{{1,2}})/(\d{{1,2}})\s+{_T}(?::(\d{{2}}))?$", "$1|$2|$3|$4|$5|$6|||"),
    Pattern(rf"^(\d{{4}})(\d{{2}})(\d{{2}})T(\d{{2}})(\d{{2}})(\d{{2}})?{_OFF}?$", "$1|$2|$3|$4|$5|$6|||$7"),
    Pattern(r"^((?:19|20)\d{2})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1|$2|$3|$4|$5|$6|||"),
    Pattern(r"^((?:19|20)\d{2})(\d{2})(\d{2})$", "$1|$2|$3||||||"),
    Pattern(rf"^[A-Za-z]{{3,9}},\s*(\d{{1,2}})\s+([A-Za-z]{{3,9}})\.?\s+(\d{{4}})\s+{_T}(?::(\d{{2}}))?\s*{_OFF}$", "$3|$2|$1|$4|$5|$6|||$7"),
    Pattern(rf"^[A-Za-z]{{3,9}},\s*(\d{{1,2}})\s+([A-Za-z]{{3,9}})\.?\s+(\d{{4}})\s+{_T}(?::(\d{{2}}))?\s+{_ABBR}$", "$3|$2|$1|$4|$5|$6|||@$7"),
    Pattern(rf"^([A-Za-z]{{3,9}})\.?\s+(\d{{1,2}}),\s*(\d{{4}})\s+{_T}(?::(\d{{2}}))?\s*(AM|PM|am|pm)?\s*{_ABBR}$", "$3|$1|$2|$4|$5|$6||$7|@$8"),
    Pattern(rf"^([A-Za-z]{{3,9}})\.?\s+(\d{{1,2}}),\s*(\d{{4}})(?:\s+{_T}(?::(\d{{2}}))?\s*(AM|PM|am|pm)?)?$", "$3|$1|$2|$4|$5|$6||$7|"),
    Pattern(rf"^(\d{{4}})年(\d{{1,2}})月(\d{{1,2}})日(?:\s*({_CN_AM}|{_CN_PM})?\s*{_T}(?::(\d{{2}}))?)?$", "$1|$2|$3|$5|$6|$7||$4|"),
    Pattern(r"^(\d{4})年(\d{1,2})月(\d{1,2})日\s*(\d{1,2})[時时点](?:(\d{1,2})分)?(?:(\d{1,2})秒)?$", "$1|$2|$3|$4|$5|$6|||"),
    Pattern(rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})(?:\s+{_T}(?::(\d{{2}}))?\s*(AM|PM|am|pm)?)?$", "$3|$1|$2|$4|$5|$6||$7|", "M"),
    Pattern(rf"^(\d{{1,2}})[/.](\d{{1,2}})[/.](\d{{4}})(?:\s+{_T}(?::(\d{{2}}))?\s*(AM|PM|am|pm)?(?:\s*Uhr)?)?$", "$3|$2|$1|$4|$5|$6||$7|", "D"),
    Pattern(r"^(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2})h(\d{2})(?:m?(\d{2})s?)?$", "$3|$2|$1|$4|$5|$6|||", "D"),
)
#: Locales whose numeric dates begin with the month.
MONTH_FIRST = ("en-US",)
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def abbreviations(zones: list[str], first_year: int = 1990, last_year: int = 2040) -> dict[str, int]:
    """``zone@abbreviation`` to offset in seconds, from the zone database."""
    out: dict[str, int] = {}
    for zone in zones:
        try:
            info = ZoneInfo(zone)
        except (KeyError, ValueError, OSError):
            continue
        at = datetime(first_year, 1, 1, tzinfo=UTC)
        while at.year < last_year:
            local = at.astimezone(info)
            out[f"{zone}@{local.tzname()}"] = int(local.utcoffset().total_seconds())
            at += timedelta(days=30)
    return out


def _int(c: Column) -> Column:
    return F.when(c == "", F.lit(None)).otherwise(c).try_cast("long")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once.

    A chain of projections would be inlined by the planner, and every field
    computed again wherever it is used.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def utc_micros(stamp: Column, zone: Column, locale: Column, abbrs: dict[str, int]) -> Column:
    """Microseconds since 1970-01-01 UTC that ``stamp`` names, else null."""
    month_first = F.coalesce(locale.isin(*MONTH_FIRST), F.lit(False))
    known = F.create_map(*[F.lit(x) for kv in sorted(abbrs.items()) for x in kv]) if abbrs else F.lit(None).cast("map<string,int>")

    def cascade(text: Column) -> Column:
        fields = F.lit(None).cast("string")
        for p in reversed(CASCADE):
            hit = text.rlike(p.regex)
            if p.order:
                hit = hit & locale.isNotNull() & (month_first if p.order == "M" else ~month_first)
            fields = F.when(hit, F.regexp_replace(text, p.regex, p.to)).otherwise(fields)
        epoch = (
            F.when(text.rlike(r"^[12]\d{9}$"), text.try_cast("long") * 1_000_000)
            .when(text.rlike(r"^[12]\d{12}$"), text.try_cast("long") * 1000)
            .when(text.rlike(r"^[12]\d{9}\.\d{1,6}$"), (text.try_cast("decimal(20,6)") * 1_000_000).cast("long"))
        )
        return F.coalesce(epoch, _let(F.split(fields, r"\|", -1), civil))

    def civil(f: Column) -> Column:
        part = lambda i: F.get(f, F.lit(i))
        zero = lambda i: F.coalesce(_int(part(i)), F.lit(0).cast("long"))
        half, h0 = part(7), zero(3)
        pm, am = half.isin(*_CN_PM.split("|")), half.isin(*_CN_AM.split("|"))
        got = F.struct(
            _int(part(0)).alias("y"),
            F.coalesce(_int(part(1)), _month_number(part(1))).alias("mo"),
            _int(part(2)).alias("d"),
            F.when(half.isin("AM", "PM", "am", "pm") & ~h0.between(1, 12), F.lit(99).cast("long")).when(pm & (h0 < 12), h0 + 12).when(am & (h0 == 12), F.lit(0).cast("long")).otherwise(h0).alias("h"),
            zero(4).alias("mi"),
            zero(5).alias("s"),
            F.when(part(6) == "", F.lit(0).cast("long")).otherwise(_int(F.substring(F.rpad(part(6), 6, "0"), 1, 6))).alias("us"),
            part(8).alias("off"),
        )
        return _let(got, lambda x: _let(wall_micros(x), lambda w: on_line(w, x["off"])))

    def wall_micros(x: Column) -> Column:
        y, mo, d, h, mi, s = (x[c] for c in ("y", "mo", "d", "h", "mi", "s"))
        leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
        last = F.when(mo == 2, F.when(leap, 29).otherwise(28)).when(mo.isin(4, 6, 9, 11), 30).otherwise(31)
        sound = y.between(1900, 2200) & mo.between(1, 12) & (d >= 1) & (d <= last) & h.between(0, 23) & mi.between(0, 59) & s.between(0, 59)
        yy = F.when(mo <= 2, y - 1).otherwise(y)
        doy = F.floor((153 * (mo + F.when(mo > 2, -3).otherwise(9)) + 2) / 5) + d - 1
        days = yy * 365 + F.floor(yy / 4) - F.floor(yy / 100) + F.floor(yy / 400) + doy - 719468
        return F.when(sound, ((((days * 24 + h) * 60 + mi) * 60 + s) * 1_000_000 + x["us"]).cast("long"))

    def on_line(wall: Column, zoned: Column) -> Column:
        digits = F.regexp_replace(zoned, r"[^0-9]", "")
        short = F.length(digits) <= 2
        oh = F.when(short, _int(digits)).otherwise(_int(F.substring(digits, F.lit(1), F.length(digits) - 2)))
        om = F.when(short, F.lit(0).cast("long")).otherwise(_int(F.substring(digits, F.length(digits) - 1, F.lit(2))))
        sign = F.when(F.substring(zoned, 1, 1) == "-", -1).otherwise(1)
        offset = F.when(zoned == "Z", F.lit(0)).when(zoned.rlike(r"^[+-]\d") & (oh <= 18) & (om <= 59), sign * (oh * 3600 + om * 60))
        on_clock = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(wall), zone))
        by_abbr = F.coalesce(F.try_element_at(known, F.concat(zone, zoned)), F.when(zoned.isin("@UTC", "@GMT"), F.lit(0)))
        return F.when(zoned == "", on_clock).when(zoned.startswith("@"), F.coalesce(wall - by_abbr.cast("long") * 1_000_000, on_clock)).otherwise(wall - offset * 1_000_000)

    return _let(F.regexp_replace(stamp, r"^[\s\u3000\u00a0]+|[\s\u3000\u00a0]+$", ""), cascade)


def _month_number(name: Column) -> Column:
    at = F.position(F.lower(F.substring(name, 1, 3)), F.lit("".join(_MONTHS)))
    return F.when(name.rlike("^[A-Za-z]{3}") & (at > 0) & ((at - 1) % 3 == 0), ((at - 1) / 3 + 1).cast("long"))


def normalise(df: DataFrame, key: str, stamp: str, source: str, sources: DataFrame, max_zones: int = 2000) -> DataFrame:
    """``key, utc_us`` of the rows of ``df`` whose ``stamp`` names an instant.

    ``sources`` has ``id, feed_zone, feed_locale``; of a repeated id the first
    zone and locale in order hold.
    """
    clock = sources.groupBy(F.col("id").alias("_sid")).agg(F.min("feed_zone").alias("_zone"), F.min("feed_locale").alias("_locale"))
    zones = [r["_zone"] for r in clock.select("_zone").distinct().limit(max_zones + 1).collect() if r["_zone"]]
    if len(zones) > max_zones:
        raise ValueError(f"more than {max_zones} zones")
    rows = df.select(F.col(key).alias("_key"), F.col(stamp).alias("_stamp"), F.col(source).alias("_source")).filter(F.col("_stamp").rlike(r"\d"))
    joined = rows.join(clock, F.col("_source") == F.col("_sid"), "left")
    return joined.select(F.col("_key").alias(key), utc_micros(F.col("_stamp"), F.col("_zone"), F.col("_locale"), abbreviations(zones)).alias("utc_us")).filter("utc_us IS NOT NULL")

"""Several values packed in one field (problem 3).

Ordinary characters of a field are masked, which leaves its delimiter
skeleton; one splitting rule is resolved per distinct skeleton, the rules are
broadcast (behind a check of their number; beyond it the join is shuffled), and
the values are cut out by token position.

A comma may also stand inside a value (a place and the area it lies in), so the
skeleton keeps the context of each comma: ``j`` if the right side is an area
(``containers``) that can contain the left side, or the two form one frequent
expression, else ``d`` like any delimiter.  Whatever stands in quotes is one
value.

Frequent expressions are learnt from all rows (``frequent_pairs``) by shares and
an exact binomial bound, so a row's values don't depend on the size of the
corpus; a stored result can be handed in instead.

Defined cases: null and blank fields give no value; empty values between
delimiters aren't counted; repeated rows give their values each; a field that
is one value gives ``n_values = 1``.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.bounds import binomial_lower
from millrace.session import broadcast_within, materialize

_BLANK = r"[ 　 ]"
_DELIM = rf"{_BLANK}*[;；、/|,，\n\r\t]{_BLANK}*|{_BLANK}+[·•&]{_BLANK}+|{_BLANK}+and{_BLANK}+|及"
_QUOTED = r'"(?:[^"]|"")*"'
_TOKEN = rf"{_QUOTED}|(?:{_DELIM})|(?:(?!{_DELIM}|{_QUOTED})[\s\S])+"
#: A pair of texts around a comma is one expression if it makes up PAIR_SHARE of all such pairs (so there are at most
#: 1 / PAIR_SHARE of them) and PAIR_OF_LEFT of those with its left side, and that share surely exceeds PAIR_SURE.
PAIR_SHARE, PAIR_OF_LEFT, PAIR_SURE, PAIR_ERROR = 1e-4, 0.5, 0.3, 0.05
#: Rules are broadcast up to this number of skeletons.
MAX_BROADCAST_RULES = 100_000


@dataclass(frozen=True)
class Containers:
    """What may follow a value after a comma and still belong to it.

    ``areas`` maps a folded area name to its code, ``whole`` has the folded
    names of the area that contains all others, ``members`` maps a folded name
    to the codes of the areas it lies in.
    """

    areas: dict[str, frozenset[str]] = field(default_factory=dict)
    whole: frozenset[str] = frozenset()
    members: dict[str, frozenset[str]] = field(default_factory=dict)
    pairs: frozenset[tuple[str, str]] = frozenset()

    @functools.cached_property
    def _by_bigram(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for name in self.members:
            for pair in _bigrams(name):
                out.setdefault(pair, []).append(name)
        return out

    def resembles_member(self, text: str, areas: frozenset[str], least: float = 0.3) -> bool:
        """Whether ``text`` looks like a member of one of ``areas`` (Dice coefficient of the character pairs)."""
        own = _bigrams(text)
        shared = Counter(name for pair in own for name in self._by_bigram.get(pair, ()))
        return any(2 * n / max(1, len(own) + len(_bigrams(name))) >= least and self.members[name] & areas for name, n in shared.items())


def fold(text: str) -> str:
    """Case, blanks, remarks in brackets and surrounding punctuation aside."""
    text = re.sub(r"[(（][^()（）]*[)）]", "", text) or text
    return re.sub(r"[\s　'’\-]+", "", text).strip("\"[]()（）.").casefold()


def _bigrams(text: str) -> set[str]:
    return {text[i : i + 2] for i in range(len(text) - 1)}


def joins(left: str, right: str, c: Containers) -> bool:
    """Whether a comma between ``left`` (all up to it) and ``right`` joins them."""
    parts = [fold(x) for x in re.split("[,，]", left)]
    last, right = parts[-1], fold(right)
    if not last or not right:
        return False
    if (last, right) in c.pairs:
        return True
    if right in c.whole:
        return last not in c.whole
    if right in c.areas:
        if last in c.areas or any(last.startswith(w) for w in c.whole):
            return False
        lies_in = c.members.get(last)
        if lies_in is not None:
            return bool(lies_in & c.areas[right])
        # An unknown text is taken for a misspelt member only if it looks like one.
        return c.resembles_member(last, c.areas[right])
    return False


def kind_of(token: str) -> str:
    """``d`` delimiter, ``q`` quoted, ``w`` ordinary, ``b`` blank."""
    if _DELIMITER.fullmatch(token):
        return "d"
    return "q" if len(token) > 2 and _QUOTE.fullmatch(token) else "w" if _ORDINARY.search(token) else "b"


_DELIMITER, _QUOTE, _ORDINARY = re.compile(_DELIM), re.compile(_QUOTED), re.compile(r'[^\s\u3000\u00a0"]')


def skeleton_of(tokens: Sequence[str], c: Containers) -> str:
    """The mask of each token, ``j`` for a comma that joins its sides."""
    out: list[str] = []
    value = ""
    for i, token in enumerate(tokens):
        kind = kind_of(token)
        if kind == "d" and token.strip(" \u3000\u00a0") in (",", "，") and value and i + 1 < len(tokens) and not value.startswith('"') and not tokens[i + 1].startswith('"') and joins(value, tokens[i + 1], c):
            kind = "j"
        value = "" if kind == "d" else value + token
        out.append(kind)
    return "".join(out)


def rule_of(skeleton: str) -> list[tuple[int, int]]:
    """First token (from 1) and number of tokens of each value of a skeleton: what stands between its separators, unless it is blank."""
    return [(m.start() + 1, m.end() - m.start()) for m in re.finditer("[^d]+", skeleton) if set(m.group()) - {"b"}]


def frequent_pairs(values: DataFrame, column: str, containers: Containers) -> frozenset[tuple[str, str]]:
    """Texts around a comma that nearly always stand together, such as a place and its country outside the reference list."""
    pair = r"(?:^|[;；、/|\n\r\t])\s*([^;；、/|,，\n\r\t\"\[\]]+[,，][^;；、/|,，\n\r\t\"\[\]]+?)\s*(?=$|[;；、/|\n\r\t])"
    one = (
        values.filter(F.col(column).rlike("[,，]"))
        .select(F.explode(F.regexp_extract_all(column, F.lit(pair), F.lit(1))).alias("p"))
        .select(F.trim(F.regexp_extract("p", "^(.*?)[,，]", 1)).alias("l"), F.trim(F.regexp_extract("p", "[,，](.*)$", 1)).alias("r"))
    )
    # At most two right sides have half of the pairs of a left side.
    counts = one.groupBy("l", "r").agg(F.count("*").alias("n")).groupBy("l").agg(F.sum("n").alias("n_left"), F.max_by("r", F.struct("n", "r")).alias("r"), F.max("n").alias("n"))
    counts = materialize(counts)
    total = counts.agg(F.coalesce(F.sum("n_left"), F.lit(0)).alias("n")).first()["n"]
    rows = counts.filter((F.col("n") >= PAIR_SHARE * total) & (F.col("n") >= PAIR_OF_LEFT * F.col("n_left")) & (F.col("n") > 1)).collect()
    sure = ((fold(r["l"]), fold(r["r"])) for r in rows if binomial_lower(r["n"], r["n_left"], 1 - PAIR_ERROR) >= PAIR_SURE)
    known = containers.areas.keys() | containers.members.keys() | containers.whole
    return frozenset((a, b) for a, b in sure if a not in known and b not in containers.areas and b not in containers.whole)


def _unwrap(c: Column) -> Column:
    """Without surrounding blanks, and without one pair of square brackets."""
    t = F.regexp_replace(c, r"^[\s\u3000\u00a0]+|[\s\u3000\u00a0]+$", "")
    return F.regexp_replace(t, r"^\[([\s\S]*)\]$", "$1")


def _clean(piece: Column) -> Column:
    """A piece without surrounding blanks and quotes."""
    blanks = r"^[\s\u3000\u00a0]+|[\s\u3000\u00a0]+$"
    t = F.regexp_replace(piece, blanks, "")
    t = F.when(t.rlike(r'^"[\s\S]*"$') & (F.length(t) > 1), F.replace(F.substring(t, F.lit(2), F.length(t) - 2), F.lit('""'), F.lit('"'))).otherwise(t)
    return F.regexp_replace(t, blanks, "")


def split_field(df: DataFrame, key: str, column: str, containers: Containers = Containers(), pairs: frozenset[tuple[str, str]] | None = None) -> DataFrame:
    """``key, n_values, seq_no, piece``: the values of ``column``, one per row.

    ``df`` may have any other columns; they are dropped.  ``pairs`` are
    expressions learnt before; without them they are learnt from ``df``.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("_k"), F.col(column).alias("_v")).filter(F.col("_v").rlike(r"[^\s\u3000\u00a0]"))
    learnt = frequent_pairs(rows, "_v", containers) if pairs is None else pairs
    held = spark.sparkContext.broadcast(Containers(containers.areas, containers.whole, containers.members, learnt))

    @F.pandas_udf("string")
    def skeleton(tokens: pd.Series) -> pd.Series:
        c = held.value
        return tokens.map(lambda t: None if t is None else skeleton_of(t, c))

    @F.pandas_udf("array<struct<at:int,n:int>>")
    def rule(skeletons: pd.Series) -> pd.Series:
        return skeletons.map(lambda s: [{"at": at, "n": n} for at, n in rule_of(s)])

    kind = lambda t: F.when(t.rlike(rf"^(?:{_DELIM})$"), "d").when(t.rlike(rf"^{_QUOTED}$") & (F.length(t) > 2), "q").when(t.rlike(r'[^\s\u3000\u00a0"]'), "w").otherwise("b")
    tokens = rows.select("_k", F.regexp_extract_all(_unwrap(F.col("_v")), F.lit(_TOKEN), F.lit(0)).alias("_t"))
    # Only commas have a context to look at; the other skeletons never leave the JVM.
    comma = F.exists("_t", lambda t: t.rlike(r"^[\s\u3000\u00a0]*[,，][\s\u3000\u00a0]*$"))
    marked = tokens.withColumn("_c", skeleton(F.when(comma, F.col("_t"))))
    masked = materialize(marked.select("_k", "_t", F.coalesce("_c", F.array_join(F.transform("_t", kind), "")).alias("_s")))
    rules = masked.select("_s").distinct().withColumn("_r", rule("_s"))
    placed = masked.join(broadcast_within(rules, MAX_BROADCAST_RULES), "_s")
    pieces = placed.select(
        F.col("_k"),
        F.filter(F.transform("_r", lambda r: _clean(F.array_join(F.slice("_t", r["at"], r["n"]), ""))), lambda p: p != "").alias("_p"),
    )
    return pieces.select(F.col("_k").alias(key), F.size("_p").alias("n_values"), F.posexplode("_p").alias("_pos", "piece")).select(key, "n_values", (F.col("_pos") + 1).alias("seq_no"), "piece")


def region_containers(regions: DataFrame, max_regions: int = 50_000) -> Containers:
    """Containers from a reference list of places; its size is checked."""
    rows = regions.select("region_code", "level_name", "province_code", "name_zh", "name_en", "label", "aliases").limit(max_regions + 1).collect()
    if len(rows) > max_regions:
        raise ValueError(f"more than {max_regions} regions")
    areas: dict[str, set[str]] = {}
    members: dict[str, set[str]] = {}
    whole: set[str] = set()
    for r in rows:
        names = {fold(x) for x in [r["name_zh"], r["name_en"], *(r["aliases"] or [])] if x}
        for name in names:
            if r["level_name"] in ("nation", "remote"):
                whole.add(name)
            elif r["level_name"] == "province":
                areas.setdefault(name, set()).add(r["province_code"])
            else:
                members.setdefault(name, set()).add(r["province_code"])
    frozen = lambda d: {k: frozenset(v) for k, v in d.items()}
    return Containers(frozen(areas), frozenset(whole), frozen(members))

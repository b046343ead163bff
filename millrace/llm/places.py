"""Mapping freely typed values to a canonical list (problem 1).

A multi-pattern automaton over all names and aliases of the reference list
finds mentions inside a value; the longest non-overlapping ones win, and on
Latin text they must begin and end with a word.  What remains goes to
token-set similarity, in which the order of tokens is nothing: words that match
up to a misspelling, or the characters of a Chinese name.  Candidates come from
inverted lists of character pairs and characters, so the length of the list
doesn't matter; a name as a whole is tried first by edit distance.  The finest
entry named counts; a value that names none, or several equally well, gives
``none``.

The reference list is a dimension whose size is checked (``max_regions``); it
travels to the tasks once.  Values are resolved where they stand, with a
per-worker memory for repeated ones, so no frequent value is shuffled.

Null and blank values give nothing; repeated rows give the same entry once per
record and field.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.textforms import osa_distance, simplify
from millrace.operators.split_fields import region_containers, split_field
from millrace.session import materialize

NONE = "none"
_HAN = r"[㐀-鿿]"
#: Words beside a place that name nothing.
_NOISE = {"city", "shi", "hq", "campus", "onsite", "on", "site", "province", "prov", "district", "area", "office", "cn", "headquarters"}


@dataclass(frozen=True)
class Region:
    code: str
    level: str
    province: str | None
    names: tuple[str, ...]


def load_regions(regions: DataFrame, max_regions: int = 50_000) -> tuple[Region, ...]:
    rows = regions.select("region_code", "level_name", "province_code", "name_zh", "name_en", "aliases").limit(max_regions + 1).collect()
    if len(rows) > max_regions:
        raise ValueError(f"more than {max_regions} regions")
    return tuple(sorted((Region(r["region_code"], r["level_name"], r["province_code"], tuple(sorted({x for x in [r["name_zh"], r["name_en"], *(r["aliases"] or [])] if x}))) for r in rows), key=lambda r: r.code))


#: Token-set similarity from which a name is meant.
ALIKE = 0.72


def _edits(length: int) -> int:
    """Misspellings a word of this length may have."""
    return 0 if length < 4 else 1 if length < 6 else 2 if length < 11 else 3


def token_set_similarity(a: tuple[str, ...], b: tuple[str, ...]) -> float:
    """Share of the letters of both token sets that stand in matching tokens, less their misspelt letters."""
    left, matched = list(dict.fromkeys(b)), 0.0
    for x in sorted(set(a), key=lambda w: (-len(w), w)):
        best = None
        for y in left:
            most = _edits(max(len(x), len(y)))
            d = osa_distance(x, y, most)
            if d <= most and (best is None or d < best[0]):
                best = (d, y)
        if best:
            left.remove(best[1])
            matched += (len(x) + len(best[1])) * (1 - best[0] / max(len(x), len(best[1])))
    return matched / max(1, sum(map(len, set(a))) + sum(map(len, set(b))))


def _pairs(word: str) -> frozenset[str]:
    return frozenset(word[i : i + 2] for i in range(len(word) - 1))


class PlaceIndex:
    """The automaton and the similarity index over one reference list."""

    def __init__(self, regions: tuple[Region, ...]):
        import ahocorasick

        self.region = {r.code: r for r in regions}
        codes: dict[str, set[str]] = {}
        tokens: dict[str, tuple[str, ...]] = {}
        for r in regions:
            for name in r.names:
                folded = simplify(name)
                key = re.sub(r"\s+", "", folded) if re.search(_HAN, folded) else re.sub(r"[^a-z]", "", folded)
                if key:
                    codes.setdefault(key, set()).add(r.code)
                    if key.isascii() and len(words := tuple(w for w in re.findall("[a-z]+", folded) if w not in _NOISE)) > 1:
                        tokens.setdefault(key, words)
        self.codes = {k: frozenset(v) for k, v in codes.items()}
        self.automaton = ahocorasick.Automaton()
        for key in self.codes:
            self.automaton.add_word(key, key)
        if self.codes:
            self.automaton.make_automaton()
        self.latin = {k: _pairs(k) for k in self.codes if k.isascii() and len(k) >= 4}
        self.by_pair: dict[str, list[str]] = {}
        for k, pairs in self.latin.items():
            for p in pairs:
                self.by_pair.setdefault(p, []).append(k)
        self.tokens = tokens
        # Cities by the characters of their names; full forms are found through the short ones.
        self.by_char: dict[str, set[str]] = {}
        for k, c in self.codes.items():
            if not k.isascii() and len(k) >= 3 and k[-1] not in "省市" and any(self.region[x].level == "city" for x in c):
                for char in k:
                    self.by_char.setdefault(char, set()).add(k)

    def mentions(self, text: str, starts: set[int] | None = None, ends: set[int] | None = None) -> list[tuple[int, int, str]]:
        """Longest non-overlapping mentions, optionally on word boundaries."""
        if not text or not self.codes:
            return []
        found = []
        for last, key in self.automaton.iter(text):
            begin = last + 1 - len(key)
            if starts is None or (begin in starts and last + 1 in ends):
                found.append((begin, last + 1, key))
        taken: list[tuple[int, int, str]] = []
        for m in sorted(found, key=lambda m: (m[0] - m[1], m[0])):
            if all(m[1] <= t[0] or m[0] >= t[1] for t in taken):
                taken.append(m)
        return sorted(taken)

    def near_latin(self, word: str) -> dict[str, float]:
        """Listed names nearest to a misspelt word, with their rank value (smaller is nearer)."""
        most = 1 if len(word) < 6 else 2 if len(word) < 11 else 3
        if len(word) < 4:
            return {}
        pairs = _pairs(word)
        shared: dict[str, int] = {}
        for p in pairs:
            for k in self.by_pair.get(p, ()):
                shared[k] = shared.get(k, 0) + 1
        out = {}
        for k, n in shared.items():
            likeness = 2 * n / (len(pairs) + len(self.latin[k]))
            if likeness >= 0.25 and abs(len(k) - len(word)) <= most:
                d = osa_distance(word, k, most)
                if d <= most:
                    out[k] = d - likeness / 1000
        return out

    def near_tokens(self, run: list[str]) -> dict[str, float]:
        """Listed names of several words that have nearly the words of ``run``, in any order, by rank value."""
        words = tuple(w for w in run if w not in _NOISE)
        if len(words) < 2:
            return {}
        shared: dict[str, int] = {}
        for p in frozenset().union(*(_pairs(w) for w in words)):
            for k in self.by_pair.get(p, ()):
                shared[k] = shared.get(k, 0) + 1
        out = {}
        for k in shared:
            if k in self.tokens and (likeness := token_set_similarity(words, self.tokens[k])) >= ALIKE:
                out[k] = 5 - likeness
        return out

    def near_han(self, text: str, provinces: set[str]) -> set[str]:
        """Cities one of whose names a stretch of ``text`` spells with other order or one wrong, lacking or added character (two from six characters on)."""
        shared: dict[str, int] = {}
        for char in set(text):
            for k in self.by_char.get(char, ()):
                shared[k] = shared.get(k, 0) + 1
        best: dict[int, set[str]] = {}
        for k, n in shared.items():
            most = 1 if len(k) < 6 else 2
            if n < len(set(k)) - most:
                continue
            fit = {c for c in self.codes[k] if self.region[c].level == "city" and (not provinces or self.region[c].province in provinces)}
            sizes = {len(k)} if len(k) == 3 else {len(k) - 1, len(k), len(k) + 1}
            near = min((min(most, osa_distance(w, k, most)) if sorted(w) == sorted(k) else osa_distance(w, k, most) for size in sizes for i in range(max(0, len(text) - size + 1)) for w in (text[i : i + size],)), default=most + 1)
            if fit and near <= most:
                best.setdefault(near if len(k) > 3 else 1, set()).update(fit)
        return best[min(best)] if best else set()

    def resolve(self, value: str) -> str:
        """The entry's code, or ``none``."""
        return self.verdict(value) or NONE

    def verdict(self, value: str) -> str | None:
        """As ``resolve``, but None if nothing is named and ``none`` only if several fit equally well."""
        text = simplify(value)
        main = re.sub(r"[(（\[【][^)）\]】]*[)）\]】]", " ", text)
        got = self._resolve(main if re.search(rf"[a-z]|{_HAN}", main) else text)
        if got in (None, NONE) or self.region[got].level == "nation":
            rest = " ".join(re.findall(r"[(（\[【]([^)）\]】]*)[)）\]】]", text))
            if got is None and re.search(rf"[a-z]|{_HAN}", rest):
                whole = self._resolve(rest)
                if whole not in (None, NONE) and self.region[whole].level in ("nation", "remote"):
                    got = whole if re.fullmatch(r"\W*", main) else None
        return got

    def _resolve(self, text: str) -> str | None:
        """Code, ``none`` if several fit equally well, None if nothing is named."""
        han = "".join(re.findall(_HAN, text))
        words = re.findall(r"[a-z]+", text)
        joined = "".join(words)
        ends, at = set(), 0
        for w in words:
            at += len(w)
            ends.add(at)
        starts = {0} | ends
        found = [(b, e, k, False) for b, e, k in self.mentions(joined, starts, ends)] + [(b, e, k, True) for b, e, k in self.mentions(han)]
        sets = [self.codes[k] for *_, k, _ in found]
        level = lambda s, name: {c for c in s if self.region[c].level == name}
        provinces = set().union(*(level(s, "province") for s in sets)) if sets else set()
        cities = [x for s in sets if (x := level(s, "city"))]
        whole = set().union(*(level(s, "nation") | level(s, "remote") for s in sets)) if sets else set()
        if not cities:
            cities = self._remaining(joined, words, han, found, provinces)
            if cities and all(self.region[c].level != "city" for s in cities for c in s):
                flat = set().union(*cities)
                if not provinces and not whole:
                    return next(iter(flat)) if len(flat) == 1 else NONE
                cities = []
        if cities:
            fit = [({c for c in s if self.region[c].province in provinces} or s) if provinces else s for s in cities]
            common = set.intersection(*map(set, fit)) or set().union(*fit)
            return next(iter(common)) if len(common) == 1 else NONE
        if provinces:
            return next(iter(provinces)) if len(provinces) == 1 else NONE
        remote = {c for c in whole if self.region[c].level == "remote"}
        if remote or whole:
            pick = remote or whole
            return next(iter(pick)) if len(pick) == 1 else NONE
        return None

    def _remaining(self, joined: str, words: list[str], han: str, found: list[tuple[int, int, str, bool]], provinces: set[str]) -> list[set[str]]:
        """Token-set similarity for the words no mention covers."""
        out: list[set[str]] = []
        spans = [(b, e) for b, e, _, is_han in found if not is_han]
        free, at, runs = [], 0, []
        for w in words:
            if w in _NOISE or any(b <= at < e for b, e in spans):
                if free:
                    runs.append(free)
                free = []
            else:
                free.append(w)
            at += len(w)
        if free:
            runs.append(free)
        for run in runs:
            near: dict[str, float] = {}
            for word in {"".join(run), *run}:
                for k, d in self.near_latin(word).items():
                    near[k] = min(d, near.get(k, 9.0))
            if not near:
                near = self.near_tokens(run)
            if provinces:
                inside = {k: d for k, d in near.items() if any(self.region[c].province in provinces and self.region[c].level == "city" for c in self.codes[k])}
                near = inside or near
            if near:
                least = min(near.values())
                best = set().union(*(self.codes[k] for k, d in near.items() if d == least))
                if provinces:
                    best = {c for c in best if self.region[c].province in provinces} or best
                out.append(best)
        if not out and han:
            rest = han
            for *_, k, is_han in found:
                if is_han:
                    rest = rest.replace(k, " ", 1)
            if near_han := self.near_han(rest, provinces):
                out.append(near_han)
        return out


@functools.lru_cache(maxsize=2)
def _index(regions: tuple[Region, ...]) -> PlaceIndex:
    return PlaceIndex(regions)


def resolver(spark, regions: tuple[Region, ...], remembered: int = 100_000):
    """Column function: typed value to region code, or ``none`` (``none:several`` with ``verdicts``)."""
    held = spark.sparkContext.broadcast(regions)

    def column(verdicts: bool = False):
        @F.pandas_udf("string")
        def resolve(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            index = _index(held.value)
            one = functools.lru_cache(maxsize=remembered)(index.verdict)
            for s in batches:
                # Each distinct value of a batch once.
                at, values = pd.factorize(s)
                found = [one(v) for v in values]
                codes = [(f"{NONE}:several" if verdicts and x == NONE else x) or NONE for x in found] + [None]
                yield pd.Series(codes, dtype=object).iloc[at].reset_index(drop=True)

        return resolve

    return column


def typed_values(jobs: DataFrame, regions: DataFrame) -> DataFrame:
    """``rec_id, field_name, value``: every place typed, nulls and blanks aside."""
    typed = split_field(jobs, "rec_id", "location", region_containers(regions)).select("rec_id", F.lit("location").alias("field_name"), F.col("piece").alias("value"))
    raw = jobs.select("rec_id", F.lit("work_locations_raw").alias("field_name"), F.explode("work_locations_raw").alias("value"))
    return typed.unionByName(raw).filter(F.col("value").rlike(r"[^\s\u3000\u00a0]"))


def map_places(jobs: DataFrame, regions: DataFrame) -> DataFrame:
    """``rec_id, field_name, region_code``: the entries each record's fields name."""
    resolve = resolver(jobs.sparkSession, load_regions(regions))()
    return typed_values(jobs, regions).select("rec_id", "field_name", resolve("value").alias("region_code")).distinct()


def unmatched_values(jobs: DataFrame, regions: DataFrame) -> DataFrame:
    """``field_name, value, reason, records, share``: every value without an entry and in how many records it stands.

    ``reason`` is ``no entry`` or ``several entries``; ``share`` is that of the
    field's records with any value.
    """
    resolve = resolver(jobs.sparkSession, load_regions(regions))(True)
    values = materialize(typed_values(jobs, regions).select("field_name", "rec_id", "value").distinct())
    total = values.groupBy("field_name").agg(F.countDistinct("rec_id").alias("_all"))
    counted = values.groupBy("field_name", "value").agg(F.count("*").alias("records")).withColumn("_c", resolve("value"))
    reason = F.when(F.col("_c") == NONE, "no entry").otherwise("several entries")
    missed = counted.filter(F.col("_c").startswith(NONE)).join(F.broadcast(total), "field_name")
    return missed.select("field_name", "value", reason.alias("reason"), "records", F.round(F.col("records") / F.col("_all"), 6).alias("share"))

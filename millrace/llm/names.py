"""Variant spellings of names (problem 2).

Every distinct text is rewritten into its canonical forms: legal form and
place dropped, scripts and widths folded, line of business brought to its full
word, nicknames replaced, words reordered, joined, reduced to an initial or to
the acronym, letters left out.  The forms are exploded and equi-joined; a form
links the spellings that share it only as far as it is rare: plain rewritings
always, misspellings towards the most frequent spelling of the form, forms that
drop something telling (the line of business, a first name) only if all that
share it otherwise are one employer.  Of several such employers the one with
the highest score wins, the score being the rarity of the form (the logarithm
of all spellings over those that share it), if it leads by ``LEAD``.  A listed
name and its aliases are one employer; nickname rules are learnt from listed
names whose alias differs in one word.

Links are stars around one spelling per form, so no form makes all pairs and no
form's spellings are gathered in one row; the pairs of the result come from the
final classes.  Null and blank texts take no part; equal texts count once;
texts without any telling part stay alone.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.components import components
from millrace.llm.places import load_regions
from millrace.llm.textforms import osa_distance, simplify
from millrace.session import materialize

_HAN = "㐀-鿿"
# Legal forms.
_LEGAL_HAN = re.compile("(?:有限责任公司|股份有限公司|集团有限公司|有限公司|股份公司|集团公司|公司|集团)$")
_LEGAL_LATIN = frozenset("gmbh inc incorporated co ltd limited corp corporation company group grp llc plc ag the".split())
# Abbreviations that share no letters' order with their word.
_WRITTEN_OUT = {"s/w": "software"}
#: An ending is a line of business if this share of all Chinese names ends so; hence at most 1 / ENDING_SHARE endings.
ENDING_SHARE = 0.004
#: A Chinese misspelling that carries a place joins a spelling without one only if that one is so many times more frequent.
DOMINANT = 4


#: By how much the score of a form that drops something must exceed that of any other employer's.
LEAD = math.log(2)
#: What each letter or word a form leaves open costs.
OPEN = 50.0
#: Members of an employer that one task pairs with another such part.
PART = 2000


@dataclass(frozen=True)
class Lexicon:
    places_han: tuple[str, ...]
    places_latin: frozenset[str]
    lines_han: tuple[str, ...]
    lines_latin: tuple[str, ...]
    nicknames: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Parsed:
    script: str
    core: tuple[str, ...]
    line: str
    place: str

    @property
    def key(self) -> str:
        return f"{self.script}|{' '.join(self.core)}|{self.line}"


@functools.lru_cache(maxsize=4)
def _place_pattern(places: tuple[str, ...]) -> re.Pattern:
    return re.compile("|".join(sorted(map(re.escape, places), key=len, reverse=True)) or r"(?!)")


def strip_han(text: str, lex: Lexicon) -> tuple[str, str]:
    """A folded Chinese name without place and legal form, and the places."""
    places: list[str] = []
    pattern = _place_pattern(lex.places_han)
    t = re.sub(r"\s+", "", text)

    def bracket(m: re.Match) -> str:
        if pattern.fullmatch(m[1]) or re.fullmatch(f"(?:{pattern.pattern})+[省市区]?", m[1]):
            places.append(m[1])
            return ""
        return m[1]

    t = re.sub(r"[(\[【〔]([^)\]】〕]*)[)\]】〕]", bracket, t)
    if (m := re.search(r"[-–—·]([^-–—·]+)$", t)) and re.fullmatch(f"(?:{pattern.pattern})+[省市]?", m[1]):
        places.append(m[1])
        t = t[: m.start()]
    while (m := _LEGAL_HAN.search(t)) and m.start() > 0:
        t = t[: m.start()]
    while (m := pattern.match(t)) and len(t) - m.end() >= 3:
        places.append(m.group())
        t = re.sub("^[省市](?=.{3})", "", t[m.end() :])
    return re.sub(rf"[^{_HAN}a-z0-9]", "", t), places[-1].rstrip("省市") if places else ""


def line_candidates(word: str, lines: tuple[str, ...]) -> list[str]:
    """Lines of business that ``word`` writes out, abbreviates or misspells."""
    if word in lines:
        return [word]
    if len(word) < 3:
        return []
    out = [x for x in lines if x.startswith(word)]
    if not out and len(word) <= 6:

        def inside(x: str) -> bool:
            letters = iter(x)
            return x[0] == word[0] and all(c in letters for c in word) and not set(word[1:]) & set("aeiou") - set("e")

        out = [x for x in lines if inside(x)]
    if not out and len(word) >= 5:
        most = 1 if len(word) < 8 else 2
        out = [x for x in lines if osa_distance(word, x, most) <= most]
    return sorted(out, key=len)


def parse(text: str, lex: Lexicon) -> list[Parsed]:
    """Readings of a name; more than one if an abbreviation is ambiguous."""
    if re.search(f"[{_HAN}]", text):
        base, place = strip_han(simplify(text), lex)
        line = next((x for x in lex.lines_han if base.endswith(x) and len(base) > len(x) + 1), "")
        core = base[: len(base) - len(line)] if line else base
        return [Parsed("z", (core,), line, place)] if core else []
    plain = re.sub(r"(?i)\bg\.?m\.?b\.?h\b\.?", " ", text)
    t = simplify(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", plain))
    for short, word in _WRITTEN_OUT.items():
        t = t.replace(short, word)
    place = ""

    def bracket(m: re.Match) -> str:
        nonlocal place
        inner = re.sub("[^a-z]", "", m[1])
        if inner in lex.places_latin:
            place = inner
            return " "
        return f" {m[1]} "

    t = re.sub(r"\(([^)]*)\)", bracket, t)
    words = [w for w in re.findall(r"[^\W\d_]+", t)]
    words = [w for w in words if w not in _LEGAL_LATIN]
    if len(words) > 1 and words[-1] == "china":
        words.pop()
    kept = []
    for w in words:
        if w in lex.places_latin and len(words) > 2:
            place = w
        else:
            kept.append(w)
    words = kept or words
    lines: list[str] = []
    if len(words) > 1:
        for i in [len(words) - 1, *range(len(words) - 1)]:
            if len(words[i]) > 1 and (lines := line_candidates(words[i], lex.lines_latin)):
                words = words[:i] + words[i + 1 :]
                break
    core = tuple(sorted(w for w in words))
    return [Parsed("e", core, x, place) for x in (lines or [""])] if core else []


def _deletions(word: str, most: int) -> set[str]:
    out = {word}
    edge = {word}
    for _ in range(most):
        edge = {w[:i] + w[i + 1 :] for w in edge for i in range(len(w))}
        out |= edge
    return out


def nickname_rule(name: Parsed, alias: Parsed) -> tuple[str, str] | None:
    """The word of ``alias`` that stands for a word of ``name``, if they differ in just that."""
    short, full = set(alias.core) - set(name.core), set(name.core) - set(alias.core)
    if name.script == alias.script == "e" and name.line == alias.line and len(name.core) == len(alias.core) > 1 and len(short) == len(full) == 1:
        nick, word = short.pop(), full.pop()
        return (nick, word) if len(nick) > 1 and len(word) > 1 else None
    return None


def acronym(p: Parsed) -> str:
    """First letters of the words in order of the alphabet, with the line of business."""
    return "".join(sorted(w[0] for w in (*p.core, *([p.line] if p.line else []))))


def forms(p: Parsed, nicknames: dict[str, set[str]] | None = None, shown: str = "") -> Iterator[tuple[str, str]]:
    """``kind, form``: ``x`` plain rewritings, ``t`` misspellings, ``w`` forms that drop something telling."""
    for i, word in enumerate(p.core if nicknames and len(p.core) > 1 else ()):
        for full in nicknames.get(word, ()):
            yield "x", f"e={' '.join(sorted((*p.core[:i], full, *p.core[i + 1 :])))}|{p.line}"
    if p.script == "e" and is_full(p) and len(p.core) > 1:
        yield "w", f"e#{acronym(p)}"
    elif len(p.core) == 1 and not p.line and re.fullmatch(r"(?:[A-Z]\.?){3,5}", shown.strip()):
        yield "w", f"e#{''.join(sorted(p.core[0]))}"
    if p.script == "z":
        (core,) = p.core
        yield "x", f"z={core}|{p.line}"
        if p.line and len(core) >= 2:
            yield "t", f"z~{''.join(sorted(core))}|{p.line}"
            for i in range(len(core)):
                yield "t", f"z_{core[:i]}_{core[i + 1 :]}|{p.line}"
        yield "w", f"z-{core}"
        return
    whole = "".join(p.core)
    yield "x", f"e={' '.join(p.core)}|{p.line}"
    names = [w for w in p.core if len(w) > 1]
    if len(p.core) == 2 and len(names) == 2:
        a, b = p.core
        for joined in (a + b, b + a):
            yield "x", f"e+{joined}|{p.line}"
            for d in _deletions(joined, 1):
                yield "t", f"e+~{d}|{p.line}"
            yield "w", f"e-{joined}"
        for x in _deletions(a, 1):
            for y in _deletions(b, 1):
                yield "t", f"e~~{min(x, y)} {max(x, y)}|{p.line}"
        for one, two in ((a, b), (b, a)):
            yield "w", f"e..{one[0]} {two}"
            for d in _deletions(two, 2):
                yield "t", f"e~{one} {d}|{p.line}"
            for d in _deletions(two, 1):
                yield "w", f"e.{one[0]} {d}|{p.line}"
                yield "w", f"e-~{one} {d}"
    elif len(p.core) == 2 and len(names) == 1:
        initial = next(w for w in p.core if len(w) == 1)
        for d in _deletions(names[0], 1):
            yield "w", f"e.{initial} {d}|{p.line}"
        if not p.line:
            yield "w", f"e..{initial} {names[0]}"
    else:
        yield "x", f"e+{whole}|{p.line}"
        if len(whole) >= 8:
            for d in _deletions(whole, 1):
                yield "t", f"e+~{d}|{p.line}"
        yield "w", f"e-{whole}"


def is_full(p: Parsed) -> bool:
    """Whether nothing telling is missing."""
    return bool(p.line) and (p.script == "z" or all(len(w) > 1 for w in p.core))


def _distinct_names(jobs: DataFrame, sources: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``text, n, listed`` of every text to link or to link through; ``name, alias`` of the list."""
    parts = [jobs.select(F.col("company").alias("text")), sources.select(F.col("name").alias("text")), targets.select(F.col("name").alias("text"))]
    shown = parts[0].unionByName(parts[1]).unionByName(parts[2]).filter(F.col("text").rlike(r"\S")).groupBy("text").agg(F.count("*").alias("n"))
    known = targets.select("name", F.explode("aliases").alias("alias")).filter(F.col("name").rlike(r"\S") & F.col("alias").rlike(r"\S")).distinct()
    aliases = known.select(F.col("alias").alias("text")).distinct().join(shown, "text", "left_anti").withColumn("n", F.lit(0).cast("long"))
    both = shown.withColumn("listed", F.lit(True)).unionByName(aliases.withColumn("listed", F.lit(False)))
    return materialize(both), known


def _lexicon(names: DataFrame, regions: DataFrame, targets: DataFrame, max_lines: int = 1000) -> Lexicon:
    places = load_regions(regions)
    folded = {simplify(n) for r in places if r.level in ("province", "city") for n in r.names}
    han = sorted(x for x in folded if re.search(f"[{_HAN}]", x))
    latin = frozenset(re.sub("[^a-z]", "", x) for x in folded if x.isascii())
    legal = _LEGAL_HAN.pattern
    ends = names.filter(F.col("text").rlike(legal)).select(F.regexp_replace("text", legal, "").alias("t")).filter(F.length("t") > 3)
    total = ends.count()
    counted = ends.select(F.explode(F.array(F.expr("right(t, 2)"), F.expr("right(t, 3)"))).alias("e")).groupBy("e").agg(F.count("*").alias("n")).filter(F.col("n") >= F.greatest(F.lit(3), F.lit(ENDING_SHARE * total)))
    found = {r["e"]: r["n"] for r in counted.limit(int(3 / ENDING_SHARE)).collect()}
    # Three characters make the ending if they nearly always stand before its last two.
    long = {e for e, n in found.items() if len(e) == 3 and n >= 0.8 * found.get(e[1:], n)}
    ends_han = tuple(sorted(long | {e for e in found if len(e) == 2 and not any(x.endswith(e) for x in long)}, key=lambda e: (-len(e), e)))
    lines = tuple(sorted(r["l"] for r in targets.select(F.lower(F.trim("industry")).alias("l")).distinct().filter("l IS NOT NULL AND l <> ''").limit(max_lines + 1).collect()))
    if len(lines) > max_lines:
        raise ValueError(f"more than {max_lines} industries")
    return Lexicon(tuple(han), latin, ends_han, lines)


def _with_nicknames(known: DataFrame, lex: Lexicon, max_rules: int = 100_000) -> Lexicon:
    """``lex`` with the rules that the list of aliases gives; more than ``max_rules`` are an error."""
    held = known.sparkSession.sparkContext.broadcast(lex)

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rules = {r for name, alias in zip(pdf["name"], pdf["alias"]) for x in parse(name, held.value) for y in parse(alias, held.value) if (r := nickname_rule(x, y))}
            yield pd.DataFrame(sorted(rules), columns=["nick", "word"])

    rows = known.mapInPandas(learn, "nick string, word string").distinct().limit(max_rules + 1).collect()
    if len(rows) > max_rules:
        raise ValueError(f"more than {max_rules} nickname rules")
    return replace(lex, nicknames=tuple(sorted((r["nick"], r["word"]) for r in rows)))


def name_classes(jobs: DataFrame, sources: DataFrame, targets: DataFrame, regions: DataFrame) -> DataFrame:
    """``text, listed, employer``: the class of every distinct text."""
    names, known = _distinct_names(jobs, sources, targets)
    known = materialize(known)
    held = jobs.sparkSession.sparkContext.broadcast(_with_nicknames(known, _lexicon(names, regions, targets)))
    schema = T.StructType.fromDDL("text string, n long, listed boolean, key string, full boolean, place string, kind string, form string")

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lex = held.value
        nicknames: dict[str, set[str]] = {}
        for nick, word in lex.nicknames:
            nicknames.setdefault(nick, set()).add(word)
        for pdf in batches:
            rows = []
            for text, n, listed in zip(pdf["text"], pdf["n"], pdf["listed"]):
                readings = parse(text, lex)
                for p in readings:
                    full = is_full(p) and len(readings) == 1
                    key = p.key if len(readings) == 1 else f"?|{' '.join(p.core)}|{'/'.join(x.line for x in readings)}"
                    for kind, form in set(forms(p, nicknames, text)):
                        rows.append((text, n, listed, key, full, p.place, "w" if len(readings) > 1 else kind, form))
            yield pd.DataFrame(rows, columns=schema.names)

    rewritten = materialize(names.repartition(int(jobs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "text").mapInPandas(rewrite, schema))
    texts = rewritten.select("text", "n", "listed", "key", "full", "place").distinct()
    classes = materialize(texts.groupBy("key").agg(F.sum("n").alias("n"), F.max("full").alias("full"), F.collect_set(F.when(F.col("place") != "", F.col("place"))).alias("places")))
    per_form = materialize(rewritten.select("kind", "form", "key").distinct().join(classes, "key"))
    top = F.struct("n", "key")
    # Plain rewritings: all spellings of a form go with its most frequent one.
    plain = per_form.filter("kind = 'x'")
    hubs = plain.groupBy("form").agg(F.max_by("key", top).alias("b"), F.count("*").alias("m")).filter("m > 1")
    plain = plain.join(hubs, "form").filter("key <> b").select(F.col("key").alias("a"), "b")
    # Misspellings, towards the most frequent spelling of the form.
    typo = per_form.filter("kind = 't'").select("form", "key", "n", "places")
    hubs = typo.groupBy("form").agg(F.max_by("key", top).alias("b"), F.max_by(F.struct("n", "places"), top).alias("h"), F.count("*").alias("m")).filter("m > 1")
    typo = typo.join(hubs, "form").filter("key <> b")
    apart = (F.size("places") > 0) & (F.size("h.places") > 0) & ~F.arrays_overlap("places", "h.places")
    agree = F.arrays_overlap("places", "h.places") | (F.size("places") == 0) | (F.col("h.n") >= DOMINANT * F.col("n"))
    misspelt = typo.filter(F.when(F.col("form").startswith("z"), F.coalesce(~apart, F.lit(True)) & F.coalesce(agree | F.col("form").startswith("z~"), F.lit(False))).otherwise(True)).select(F.col("key").alias("a"), "b")
    # Listed names and their aliases.
    of = texts.select("text", "key").distinct()
    listed = known.join(of.select(F.col("text").alias("name"), F.col("key").alias("a")), "name").join(of.select(F.col("text").alias("alias"), F.col("key").alias("b")), "alias").select("a", "b")
    firm = components(plain.unionByName(misspelt).unionByName(listed).distinct())
    labelled = materialize(per_form.join(firm.select(F.col("node").alias("key"), "component"), "key", "left").withColumn("component", F.coalesce("component", "key")))
    weak_forms = labelled.filter("kind = 'w'")
    # Forms that drop something: only if all full spellings that share it are one employer.
    total = classes.count()
    shared = weak_forms.groupBy("form").agg(F.count("*").alias("m"), F.countDistinct(F.when(F.col("full"), F.col("component"))).alias("employers"), F.min(F.when(F.col("full"), F.col("component"))).alias("b"))
    score = F.log(F.lit(float(max(total, 1))) / F.col("m")) - F.when(F.col("form").contains("~") | F.col("form").startswith("e.") | F.col("form").startswith("e#"), OPEN).otherwise(0.0)
    strong = shared.filter("employers = 1").select("form", "b", score.alias("score"))
    weak = weak_forms.filter("NOT full").join(strong, "form").groupBy("key", "b").agg(F.max("score").alias("score"))
    best = weak.groupBy("key").agg(F.max(F.struct("score", "b")).alias("best"))
    rivals = weak.join(best, "key").filter((F.col("b") != F.col("best.b")) & (F.col("score") > F.col("best.score") - LEAD)).select("key").distinct()
    ranked = best.join(rivals, "key", "left_anti").select(F.col("key").alias("a"), F.col("best.b").alias("b"))
    # Spellings without a full counterpart are one employer if they are equal but for what they drop.
    bare = weak_forms.filter("NOT full AND (form LIKE 'e-%' OR form LIKE 'z-%')").join(shared.filter("employers = 0").select("form"), "form")
    hubs = bare.groupBy("form").agg(F.max_by("key", top).alias("b"), F.count("*").alias("m")).filter("m > 1")
    bare = bare.join(hubs, "form").filter("key <> b").select(F.col("key").alias("a"), "b")
    # The later links are drawn between the employers found so far, so their graph is small.
    label = classes.select("key").join(firm.select(F.col("node").alias("key"), "component"), "key", "left").select("key", F.coalesce("component", "key").alias("component"))
    ends = ranked.unionByName(bare).distinct().join(label.select(F.col("key").alias("a"), F.col("component").alias("ca")), "a").join(label.select(F.col("key").alias("b"), F.col("component").alias("cb")), "b")
    later = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    final = label.join(later.select(F.col("node").alias("component"), F.col("component").alias("whole")), "component", "left").select("key", F.coalesce("whole", "component").alias("component"))
    return texts.select("text", "listed", "key").join(final, "key").groupBy("text", "listed").agg(F.min("component").alias("employer"))


def name_pairs(jobs: DataFrame, sources: DataFrame, targets: DataFrame, regions: DataFrame) -> DataFrame:
    """``name_a, name_b``, by code point: every pair of different texts of one employer.

    An employer with very many spellings is paired part by part.
    """
    classes = name_classes(jobs, sources, targets, regions).filter("listed").select("text", "employer")
    classes = materialize(classes)
    size = classes.groupBy("employer").agg(F.count("*").alias("n")).filter("n > 1").select("employer", F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    placed = classes.join(size, "employer").withColumn("part", F.pmod(F.xxhash64("text"), F.col("parts")).cast("int"))
    x = placed.select("employer", "part", F.col("text").alias("name_a"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    y = placed.select("employer", F.col("part").alias("other"), F.col("text").alias("name_b"))
    return x.join(y, ["employer", "other"]).filter("name_a < name_b").select("name_a", "name_b")

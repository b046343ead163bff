"""Text cut off by field limits (problem 4).

The corpus gives a vocabulary trie (its nodes are kept as a table of word
prefixes, so it may grow with the corpus) and counts of how words and word
pairs stand before a sentence end.  A text is cut if

* its final token is no known word but a proper prefix of known words, or
* its final words stand inside sentences and never at their end, or
* it breaks off after an opening tag, a comma, a list mark or the like, or
* a shortening mark follows that isn't part of a set phrase, or
* it is unfinished and has just the length at which its source's texts pile up
  (in characters, or in bytes at a character boundary).

A text that merely lacks its full stop, or ends in a phrase that ends others
too, is whole.  Null and blank texts are whole and count for no share.
Repeated rows are judged each; all counts run over all rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace.session import materialize

_CJK = "぀-ヿ㐀-鿿豈-﫿"
_TOKEN = re.compile(rf"[{_CJK}]|[^\W\d_{_CJK}]+(?:['’][^\W\d_]+)*|\d+|\n|<[^<>]*>|…+|[^\s]")
_MARK = re.compile(r"\s*(\[展开\]|（展开）|…\s?more|\[(?:…|\.\.\.)\]|\(more\)|(?<!\.)\.\.\.|(?<!…)…)\s*$")
_STOP = frozenset("。！？!?.;；\n…‥")
_PAUSE = frozenset("，,、:：")
_CLOSERS = frozenset("）)】]」』”\"'’》〉%")
#: Below these shares of sentence ends a final unit counts as mid-sentence.
END_SHARE, START_SHARE, KNOWN = 0.05, 0.03, 5
#: A length is a limit if this many distinct texts have it, this many times more than lengths nearby
#: (half as many times for bytes, where a limit leaves lengths of up to three bytes less).
CAP_TEXTS, CAP_RATIO, CAP_SPAN = 5, 6.0, 4

SCHEMA = "table_name string, row_key long, grp string, state string, chars int, octets int, h long, keys array<struct<kind:string,key:string>>, kind string, key string, n long, n_end long, n_mark long"
_KEYS = pa.list_(pa.struct([("kind", pa.string()), ("key", pa.string())]))


def is_stop(token: str) -> bool:
    return token in _STOP or token[0] == "…" or token[0] == "<"


def tokens_of(text: str) -> list[str]:
    """Words, single Chinese or Japanese characters and signs, case folded; numbers are all one."""
    return ["#" if t[0].isdigit() and t.isdigit() else t for t in _TOKEN.findall(text.casefold())]


def is_unit(token: str) -> bool:
    """Words, single characters and numbers."""
    return token == "#" or token[0].isalnum()


def last_state(text: str) -> tuple[str, str, list[str], str]:
    """``whole``, ``cut`` or ``open``; the text without a shortening mark; its tokens; the mark."""
    m = _MARK.search(text)
    mark = m.group(1) if m else ""
    core = text[: m.start()] if m else text.rstrip()
    tokens = tokens_of(core)
    if mark and mark not in ("…", "..."):
        return "cut", core, tokens, mark
    if not tokens:
        return "whole", core, tokens, mark
    opened = core.rfind("<")
    if opened >= 0 and ">" not in core[opened:] and re.match(r"</?[a-z]*$", core[opened:]):
        return "cut", core, tokens, mark
    last_open = max(core.rfind("<p>"), core.rfind("<li>"))
    if last_open >= 0 and last_open > max(core.rfind("</p>"), core.rfind("</li>")):
        return "cut", core, tokens, mark
    last = tokens[-1]
    if mark:
        return ("open" if is_unit(last) else "cut"), core, tokens, mark
    if re.search(r"(?:^|\n)\s*(?:\d+[.、)]?|[•\-*])$", core) and "\n" in core:
        return "cut", core, tokens, mark
    if is_stop(last) or (last in _CLOSERS and len(tokens) > 1):
        return "whole", core, tokens, mark
    if is_unit(last):
        return "open", core, tokens, mark
    return ("cut" if last in _PAUSE or last in "“‘（(【「『《—–-/•" else "whole"), core, tokens, mark


def _clause(tokens: list[str]) -> list[str]:
    """Units of the last clause."""
    i = len(tokens)
    while i and not (is_stop(tokens[i - 1]) or tokens[i - 1] in _PAUSE):
        i -= 1
    return [t for t in tokens[i:] if is_unit(t)]


def final_keys(tokens: list[str]) -> list[tuple[str, str]]:
    """What is looked up for an open end: word, pair, clause start, clause end."""
    clause = _clause(tokens)
    if not clause:
        return []
    out = [("w", clause[-1])]
    if len(tokens) > 1 and is_unit(tokens[-2]) and is_unit(tokens[-1]):
        out.append(("b", f"{tokens[-2]} {tokens[-1]}"))
    if len(clause) >= 4:
        out += [("s", " ".join(clause[:2])), ("e", " ".join(clause[-4:]))]
    return out


class Counts:
    """Sentence-end counts of one task, by kind of key."""

    def __init__(self) -> None:
        self.total, self.end, self.mark = ({k: Counter() for k in "wbse"} for _ in range(3))

    def __len__(self) -> int:
        return sum(map(len, self.total.values()))

    def add(self, tokens: list[str], mark: str) -> None:
        total, end = self.total, self.end
        unit = [is_unit(t) for t in tokens]
        total["w"].update([t for t, u in zip(tokens, unit) if u])
        total["b"].update([f"{a} {b}" for a, b, u, v in zip(tokens, tokens[1:], unit, unit[1:]) if u and v])
        begin = 0
        n = len(tokens)
        breaks = [i for i, (t, u) in enumerate(zip(tokens, unit)) if not u and (t in _PAUSE or is_stop(t))]
        for i in (*breaks, n):
            stop = i == n or tokens[i] not in _PAUSE
            first, begin = begin, i + 1
            if first < i and unit[i - 1]:
                marked = bool(mark) if i == n else tokens[i][0] == "…"
                last, pair = tokens[i - 1], f"{tokens[i - 2]} {tokens[i - 1]}" if i - first > 1 and unit[i - 2] else None
                for counter in ([self.mark] if marked else []) + ([end] if stop and not (marked and i == n) else []):
                    counter["w"][last] += 1
                    if pair:
                        counter["b"][pair] += 1
                units = [t for t, u in zip(tokens[first:i], unit[first:i]) if u]
                if len(units) >= 4 and i < n:
                    for kind, key in (("s", " ".join(units[:2])), ("e", " ".join(units[-4:]))):
                        total[kind][key] += 1
                        if stop:
                            end[kind][key] += 1

    def rows(self) -> pa.RecordBatch:
        keys = [(kind, key) for kind, counter in self.total.items() for key in counter]
        n = len(keys)
        empty = lambda t: pa.nulls(n, t)
        of = lambda counts: pa.array([counts[k].get(v, 0) for k, v in keys], pa.int64())
        out = pa.RecordBatch.from_arrays(
            [empty(pa.string()), empty(pa.int64()), empty(pa.string()), empty(pa.string()), empty(pa.int32()), empty(pa.int32()), empty(pa.int64()), empty(_KEYS), pa.array([k for k, _ in keys], pa.string()), pa.array([v for _, v in keys], pa.string()), of(self.total), of(self.end), of(self.mark)],
            names=_NAMES,
        )
        self.__init__()
        return out


_NAMES = ["table_name", "row_key", "grp", "state", "chars", "octets", "h", "keys", "kind", "key", "n", "n_end", "n_mark"]


def _scan(held_keys: int = 400_000):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts()
        for batch in batches:
            tables, row_keys, groups, texts, hashes = (c.to_pylist() for c in batch.columns)
            states, chars, octets, keys = [], [], [], []
            for text in texts:
                state, core, tokens, mark = last_state(text)
                counts.add(tokens, mark)
                states.append(state + ("+" if mark else ""))
                chars.append(len(core))
                octets.append(len(core.encode("utf-8", "replace")))
                keys.append([{"kind": k, "key": v} for k, v in final_keys(tokens)] if state == "open" else [])
            n = len(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tables, pa.string()), pa.array(row_keys, pa.int64()), pa.array(groups, pa.string()), pa.array(states, pa.string()), pa.array(chars, pa.int32()), pa.array(octets, pa.int32()), pa.array(hashes, pa.int64()), pa.array(keys, _KEYS), pa.nulls(n, pa.string()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
                names=_NAMES,
            )
            if len(counts) > held_keys:
                yield counts.rows()
        if len(counts):
            yield counts.rows()

    return scan


def _caps(rows: DataFrame) -> DataFrame:
    """``table_name, grp, unit, cap, width``: lengths at which the distinct texts of a source pile up."""
    distinct = rows.select("table_name", "grp", "h", F.explode(F.array(F.struct(F.lit("c").alias("unit"), F.col("chars").alias("len")), F.struct(F.lit("b").alias("unit"), F.col("octets").alias("len")))).alias("x")).select("table_name", "grp", "h", "x.unit", "x.len").distinct()
    counted = distinct.groupBy("table_name", "grp", "unit", "len").agg(F.count("*").alias("n"))
    by_length = W.partitionBy("table_name", "grp", "unit").orderBy("len")
    over = lambda a, b: F.coalesce(F.sum("n").over(by_length.rangeBetween(a, b)), F.lit(0))
    octets = F.col("unit") == "b"
    here = F.when(octets, over(-3, 0)).otherwise(F.col("n"))
    left = F.when(octets, over(-7, -4)).otherwise(over(-CAP_SPAN, -1) / CAP_SPAN)
    right = F.when(octets, over(1, 4)).otherwise(over(1, CAP_SPAN) / CAP_SPAN)
    spiked = counted.select("table_name", "grp", "unit", F.col("len").alias("cap"), here.alias("here"), F.greatest(left, right, F.lit(0.5)).alias("near"), F.when(octets, CAP_RATIO / 2).otherwise(CAP_RATIO).alias("ratio"))
    return spiked.filter((F.col("here") >= CAP_TEXTS) & (F.col("here") >= F.col("ratio") * F.col("near"))).select("table_name", "grp", "unit", "cap")


@dataclass(frozen=True)
class TruncationModel:
    """What a corpus says about ends: counts of words, pairs and clause ends, the trie, closing phrases and length limits.

    Written once, it gives a text the same verdict whatever corpus it comes with.
    """

    stats: DataFrame
    nodes: DataFrame
    closing: DataFrame
    caps: DataFrame

    def write(self, path: str) -> None:
        for name in ("stats", "nodes", "closing", "caps"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def read(cls, spark, path: str) -> TruncationModel:
        return cls(*(spark.read.parquet(f"{path}/{name}") for name in ("stats", "nodes", "closing", "caps")))


def _scanned(texts: DataFrame) -> DataFrame:
    rows = texts.filter(F.col("text").rlike(r"[^\s\u3000]")).select("table_name", F.col("row_key").cast("long"), "grp", "text", F.xxhash64("text").alias("h"))
    return materialize(rows.mapInArrow(_scan(), SCHEMA))


def _judged(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    judged = scanned.filter("state IS NOT NULL").select("table_name", "row_key", "grp", "state", "chars", "octets", "h", "keys")
    looked = judged.filter(F.col("state").startswith("open")).select("table_name", "row_key", F.explode("keys").alias("k")).select("table_name", "row_key", "k.kind", "k.key").distinct()
    return judged, looked


def _fit(scanned: DataFrame) -> TruncationModel:
    judged, looked = _judged(scanned)
    stats = scanned.filter("state IS NULL").groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("n_end").alias("n_end"), F.sum("n_mark").alias("n_mark"))
    # The trie: a node for each proper prefix of a word seen more than once; the pairs of single
    # characters are its nodes for texts without blanks (their ends are counted like those of words).
    words = stats.filter((F.col("kind") == "w") & (F.col("n") > 1) & (F.length("key") > 1)).select("key", "n")
    nodes = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("key") - 1), lambda i: F.substring(F.col("key"), F.lit(1), i))).alias("key"), "n").groupBy("key").agg(F.sum("n").alias("below"))
    # How often a clause end ends open texts: phrases that stand nowhere but there close postings.
    closing = looked.filter("kind = 'e'").groupBy("kind", "key").agg(F.count("*").alias("closes"))
    return TruncationModel(stats, nodes, closing, _caps(judged))


def fit_truncation(texts: DataFrame) -> TruncationModel:
    """The model of a corpus, to be written and used for other texts."""
    return _fit(_scanned(texts))


def find_truncated(texts: DataFrame, model: TruncationModel | None = None) -> DataFrame:
    """``table_name, row_key, grp, cut`` of every non-blank text.

    ``texts`` has ``table_name, row_key, grp, text``.  Without a ``model`` the
    texts are their own corpus.
    """
    scanned = _scanned(texts)
    judged, looked = _judged(scanned)
    fitted = model or _fit(scanned)
    stats, nodes, closing, own = fitted.stats, fitted.nodes, fitted.closing, 0 if model else 1
    wanted = looked.select("kind", "key").distinct()
    known = wanted.join(stats, ["kind", "key"], "left").join(nodes.withColumn("kind", F.lit("w")), ["kind", "key"], "left").join(closing, ["kind", "key"], "left")
    of = lambda kind, what: F.max(F.when(F.col("kind") == kind, F.coalesce(F.col(what), F.lit(0))))
    facts = (
        looked.join(known, ["kind", "key"])
        .groupBy("table_name", "row_key")
        .agg(*[of(k, c).alias(f"{k}_{c}") for k in "wbse" for c in ("n", "n_end", "n_mark")], of("w", "below").alias("below"), of("e", "closes").alias("closes"), F.max(F.when(F.col("kind") == "w", F.col("key"))).alias("word"))
    )
    caps = fitted.caps
    at_c = caps.filter("unit = 'c'").select("table_name", "grp", F.col("cap").alias("chars")).distinct().withColumn("at_c", F.lit(True))
    at_b = caps.filter("unit = 'b'").select("table_name", "grp", F.explode(F.sequence(F.col("cap") - 3, F.col("cap"))).alias("octets")).distinct().withColumn("at_b", F.lit(True))
    full = judged.drop("keys").join(facts, ["table_name", "row_key"], "left").join(at_c, ["table_name", "grp", "chars"], "left").join(at_b, ["table_name", "grp", "octets"], "left")
    capped = F.coalesce(F.col("at_c"), F.col("at_b"), F.lit(False))
    share = lambda k, less: (F.col(f"{k}_n_end") - less) / F.greatest(F.col(f"{k}_n") - less, F.lit(1))
    pair_known = F.coalesce(F.col("b_n") - own >= KNOWN, F.lit(False))
    single = F.col("word").rlike(rf"^[{_CJK}]$")
    # Cut words recur, too: a fragment is still unknown if it stands only where texts end, and rarely against the words it begins.
    fragment = (F.col("w_n") - own < 2) | ((F.col("w_n_end") + F.col("w_n_mark") >= 0.9 * F.col("w_n")) & (F.col("w_n") < 0.1 * F.col("below")))
    unknown_prefix = ~single & (F.col("word") != "#") & (F.coalesce("below", F.lit(0)) > 2) & fragment
    mid_sentence = F.when(pair_known, share("b", own) < END_SHARE).otherwise((F.col("w_n") - own >= KNOWN) & (share("w", own) < END_SHARE))
    mid_clause = ((F.col("s_n") >= 20) & (share("s", 0) < START_SHARE)) | ((F.col("e_n") >= KNOWN) & (share("e", 0) < 0.1))
    phrase_with_mark = F.when(pair_known, F.col("b_n_mark") / F.col("b_n") >= 0.3).otherwise(F.lit(False)) & ~F.coalesce(unknown_prefix, F.lit(False))
    set_phrase = F.coalesce((F.col("closes") >= KNOWN) & (F.col("e_n") <= 0.5 * F.col("closes")), F.lit(False))
    broken = F.coalesce(unknown_prefix, F.lit(False)) | F.coalesce(mid_sentence, F.lit(False)) | F.coalesce(mid_clause, F.lit(False)) | F.col("word").isNull()
    cut = F.when(F.col("state").startswith("cut"), True).when(F.col("state") == "open+", ~phrase_with_mark).when(F.col("state") == "open", broken | (capped & ~set_phrase)).otherwise(False)
    return full.select("table_name", "row_key", "grp", cut.alias("cut"))


def truncation_shares(judged: DataFrame) -> DataFrame:
    """``table_name, grp, texts, cut_texts, share`` per source."""
    return judged.groupBy("table_name", "grp").agg(F.count("*").alias("texts"), F.count_if("cut").alias("cut_texts")).withColumn("share", F.round(F.col("cut_texts") / F.col("texts"), 6))

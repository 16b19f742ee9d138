"""Problem 7: statistics that tell natural prose from lists, tables and junk.

Statistics of each document are ranked within its language by a range-partitioned sort
with partition offsets (exact, without a window over a language); the ranks give
empirical tail probabilities, and the sum of their negative logarithms is the outlier
score. What is not prose is defined by an absolute share of running sentences, which
ranks cannot express: below a third is not prose, prose has more than a half. Where the
cut lies between these bounds is decided by the outlier score of the document.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.operators.ranks import global_positions
from curatrix.session import materialize

# statistic: which tail is unlike prose
STATISTICS = {"words": "both", "mean_word_length": "both", "symbol_ratio": "high", "ended_lines": "low", "common_share": "low", "sentence_share": "low"}
BASIC = ("words", "mean_word_length", "symbol_ratio", "ended_lines")
JUNK, PROSE = 1 / 3, 1 / 2  # shares of running sentences: junk stays below the one, prose exceeds the other
MOST_WORDS = 1_000_000  # of the vocabulary of common words

_TAG = re.compile(r"</?[a-zA-Z!][^<>]*>")
_MARK = re.compile(r"(?:^|(?<=\s))(?:[-*•·–+]+|\[[ xX]?\]|\(?\d{1,3}[.)])(?=\s)", re.M)
_LEAD = re.compile(r"^[ \t]*(?:[-*•·–+>]+|\[[ xX]?\]|\(?\d{1,3}[.)])[ \t]+", re.M)
_BLANK = re.compile(r"\n\s*\n")
_STRIP = " \t.,;:!?\"'()[]{}<>*_`~|-–—„“”‚‘’…/\\#=+&"
_INNER_END = re.compile(r"[.!?…,;:]\s+\S")
GAP, LEAST_COMMON, LEAST_KINDS, LEAST_TOKENS = 8, 3, 3, 7
LEAST_WORDS, MOST_TOKENS = 6, 24  # of a sentence with few common words
_CLOSERS = "\"'”’»)]*_"


class _Common(dict):
    """Token -> the common word it is, or an empty text."""

    def __init__(self, words: frozenset[str]) -> None:
        super().__init__()
        self.words = words

    def __missing__(self, token: str) -> str:
        if len(self) > 1_000_000:  # forget rather than grow
            self.clear()
        core = token.strip(_STRIP)
        value = self[token] = core if core in self.words else ""
        return value


def _units(text: str, common: _Common) -> Iterator[tuple[list[str], bool]]:
    """Tokens of each line, list item or block of wrapped lines, and whether it is a list item.

    A list marker begins a unit. Lines in a row are one unit if they look like wrapped
    prose: some line breaks off behind a common word, or ends within a sentence while
    another sentence ends inside a line. Otherwise each line is a unit of its own. Lines
    that begin with markers but break off behind common words are wrapped prose as well,
    in the dress of a list.
    """
    for block in _BLANK.split(text):
        dressed = [x for x in block.split("\n") if x and not x.isspace()]
        bare = [_LEAD.sub("", x).split() for x in dressed] if len(dressed) > 1 and _LEAD.search(block) else []
        if bare and sum(1 for t in bare[:-1] if t and common[t[-1]]) * 8 >= len(bare):
            yield [x for t in bare for x in t], False
            continue
        for n, piece in enumerate(_MARK.split(block)):
            item = n > 0
            lines = [x for x in piece.split("\n") if x and not x.isspace()]
            if len(lines) > 1:
                tokens = [x.split() for x in lines]
                broken = sum(1 for t in tokens[:-1] if common[t[-1]])
                if broken * 8 >= len(lines) or (broken and _INNER_END.search(piece)):
                    yield [x for t in tokens for x in t], item
                else:
                    for t in tokens:
                        yield t, item
                        item = False
            elif lines:
                yield lines[0].split(), item


def _clauses(units: Iterator[tuple[list[str], bool]]) -> Iterator[tuple[list[str], bool]]:
    """The units cut behind each semicolon, which parts clauses in prose and entries in a list."""
    for tokens, item in units:
        a = 0
        for b, token in enumerate(tokens, 1):
            if token[-1] == ";" and b < len(tokens):
                yield tokens[a:b], item
                a = b
        yield tokens[a:] if a else tokens, item


def _sentences(tokens: list[str], words: list[str]) -> Iterator[tuple[int, int]]:
    """Stretches up to ``. ! ? …`` of ``LEAST_WORDS`` to ``MOST_TOKENS`` tokens, mostly words, with a common one in ``GAP`` on average."""
    a = 0
    for b, token in enumerate(tokens, 1):
        if not token.rstrip(_CLOSERS).endswith((".", "!", "?", "…")):
            continue
        if LEAST_WORDS <= b - a <= MOST_TOKENS and sum(map(bool, words[a:b])) * GAP >= b - a:
            cores = [re.sub("['’-]", "", x.strip(_STRIP)) for x in tokens[a:b]]
            if sum(x.isalpha() and (len(x) > 1 or bool(w)) for x, w in zip(cores, words[a:b])) >= max(LEAST_WORDS, 0.75 * (b - a)):
                yield a, b
        a = b


def prose_shares(text: str | None, common: _Common) -> tuple[float, float]:
    """(share of the tokens that are common words, share of the non-blank characters in running sentences).

    A running sentence is a stretch of a unit in which common words follow each other
    within ``GAP`` tokens, with at least ``LEAST_COMMON`` of them, ``LEAST_KINDS``
    different ones and ``LEAST_TOKENS`` tokens; or, outside list items, a whole sentence
    up to its end that has fewer common words (``_sentences``).
    """
    if not text or text.isspace():
        return 0.0, 0.0
    if "<" in text:
        text = _TAG.sub("\n", text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    total = seen = hits = inside = 0
    for tokens, item in _clauses(_units(text.lower(), common)):
        words = list(map(common.__getitem__, tokens))
        at = [i for i, w in enumerate(words) if w]
        total += sum(map(len, tokens))
        seen += len(tokens)
        hits += len(at)
        if not at or len(tokens) < LEAST_WORDS:
            continue
        running = bytearray(len(tokens))
        i = 0
        while i < len(at):
            j = i
            while j + 1 < len(at) and at[j + 1] - at[j] <= GAP:
                j += 1
            if j - i + 1 >= LEAST_COMMON:
                a, b = max(0, at[i] - 4), min(len(tokens), at[j] + 5)
                if b - a >= LEAST_TOKENS and len({words[x] for x in at[i : j + 1]}) >= LEAST_KINDS:
                    running[a:b] = b"\1" * (b - a)
            i = j + 1
        if not item and 0 in running:
            for a, b in _sentences(tokens, words):
                running[a:b] = b"\1" * (b - a)
        inside += sum(len(t) for t, r in zip(tokens, running) if r)
    return (hits / seen if seen else 0.0), (min(1.0, inside / total) if total else 0.0)


def language_key(lang: Column) -> Column:
    """Two letters of a language however it is spelt; ``und`` if missing or unknown."""
    two = F.regexp_extract(F.lower(F.trim(lang)), "^([a-z]{2})([-_].*)?$", 1)
    return F.coalesce(F.nullif(two, F.lit("")), F.lit("und"))


def basic_statistics(text: str = "text") -> list[Column]:
    """``words``, ``mean_word_length``, ``symbol_ratio`` and ``ended_lines`` of a text column, as built-in expressions."""
    text = F.coalesce(text, F.lit(""))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]+", ""))
    filled = F.length(F.regexp_replace(text, r"\s+", ""))
    words = F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+"))
    lines = F.regexp_count(text, F.lit(r"\S[^\n]*"))
    ended = F.regexp_count(text, F.lit(r"[.!?;:…][\"'”’»)\]]*[ \t\r]*(?:\n|\z)"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return [
        words.cast("long").alias("words"),
        ratio(letters, words).alias("mean_word_length"),
        ratio(filled - letters, filled).alias("symbol_ratio"),
        F.least(F.lit(1.0), ratio(ended, lines)).alias("ended_lines"),
    ]


def text_statistics(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """Columns ``doc_id, lang_key`` and the six statistics, one row for each row of ``documents(doc_id, text, lang)``.

    ``words`` (runs of letters and digits), ``mean_word_length`` (letters and digits a
    word), ``symbol_ratio`` (non-blank characters that are neither), ``ended_lines``
    (share of the lines with text that end in ``. ! ? ; : …``, closing quotes or
    brackets allowed), ``common_share`` and ``sentence_share`` (``prose_shares``, the
    common words of all languages together, as texts mix them). All are 0 for a null or
    blank text. Texts are read whole. The first four stay in the JVM; the last two need a
    scan over tokens and run on Arrow batches. ``common_words`` is a fixed vocabulary and
    is collected; more than ``MOST_WORDS`` words raise.
    """
    known = [r[0].lower() for r in common_words.select("word").where("word is not null").distinct().limit(MOST_WORDS + 1).collect()]
    if len(known) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} common words")
    vocabulary = frozenset(known)
    kind = dict(documents.dtypes)["doc_id"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = _Common(vocabulary)
        for b in batches:
            pairs = [prose_shares(t, common) for t in b.column(3).to_pylist()]
            cols = [pa.array([p[k] for p in pairs], pa.float64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *cols], ["doc_id", "lang_key", "basic", "common_share", "sentence_share"])

    basic = F.struct(*basic_statistics())
    rows = documents.select("doc_id", language_key(F.col("lang")).alias("lang_key"), basic.alias("basic"), "text")
    shape = "struct<words:bigint,mean_word_length:double,symbol_ratio:double,ended_lines:double>"
    rows = rows.mapInArrow(scan, f"doc_id {kind}, lang_key string, basic {shape}, common_share double, sentence_share double")
    return rows.select("doc_id", "lang_key", "basic.*", "common_share", "sentence_share")


def tail_scores(statistics: DataFrame, names: tuple[str, ...] | list[str] | None = None, most_broadcast: int = 300_000) -> DataFrame:
    """The statistics with ``score``, the sum of -ln of the tail probabilities of ``names`` (all six by default).

    Within a language, the tail of a value is the share of documents with a value at
    least as far out (ties included), low, high or twice the smaller of both as
    ``STATISTICS`` has it. Values are ranked as they are, not in steps. A null statistic
    counts as 0, a null language as ``und``; an empty table gives an empty result.

    Documents are first counted by language, statistic and value; the counts are sorted
    by range and added up with partition offsets, which ranks any number of documents
    exactly. With at most ``most_broadcast`` different values (checked) each statistic
    looks its tail up in a broadcast, and the documents are not shuffled; beyond that
    they are joined by value.
    """
    names = list(names or STATISTICS)
    own = [c for c in statistics.columns if c != "score"]
    filled = statistics.select(*own).withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in names} | {"lang_key": F.coalesce("lang_key", F.lit("und"))})
    table = materialize(filled.withColumn("__row", F.monotonically_increasing_id()), "statistics")
    pairs = F.explode(F.array(*(F.struct(F.lit(i).alias("stat"), F.col(c).alias("value")) for i, c in enumerate(names)))).alias("p")
    long = table.select("__row", "lang_key", pairs).select("__row", "lang_key", "p.stat", "p.value")
    keys = ["lang_key", "stat", "value"]
    counts = global_positions(long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys, "before", weight="n")
    counts = materialize(counts, "counts")
    ends = counts.groupBy("lang_key", "stat").agg(F.min("before").alias("first"), F.sum("n").alias("all"))  # a few rows a language
    low, high = (F.col("before") - F.col("first") + F.col("n")) / F.col("all"), (F.col("all") - (F.col("before") - F.col("first"))) / F.col("all")
    side = F.lit(None).cast("double")
    for i, c in enumerate(names):
        tail = {"low": low, "high": high, "both": F.least(F.lit(1.0), 2 * F.least(low, high))}[STATISTICS[c]]
        side = F.when(F.col("stat") == i, tail).otherwise(side)
    tails = counts.join(F.broadcast(ends), ["lang_key", "stat"]).select(*keys, (-F.ln(side)).alias("weight"))
    types = dict(statistics.dtypes)
    if counts.count() <= most_broadcast:
        scored = table
        for i, c in enumerate(names):
            scored = scored.join(F.broadcast(tails.where(F.col("stat") == i).select("lang_key", F.col("value").alias(c), F.col("weight").alias(f"__{i}"))), ["lang_key", c])
        scored = scored.withColumn("score", sum((F.col(f"__{i}") for i in range(1, len(names))), F.col("__0")))
    else:
        scored = table.join(long.join(tails, keys).groupBy("__row").agg(F.sum("weight").alias("score")), "__row")
    return scored.select(*(F.col(c).cast(types[c]).alias(c) for c in own), "score")


def not_prose(scores: DataFrame) -> DataFrame:
    """Documents that are not natural prose, of ``tail_scores`` of all six statistics: their share of running sentences is below their cut.

    The cut of a document lies between ``JUNK`` and ``PROSE``, the bounds of the definition,
    where its score lies between the mean scores of the documents of its language that are
    prose (a share above ``PROSE``) and that are not (below ``JUNK``): a document as usual as
    prose needs a third in sentences, an outlier like junk a half. Where a language lacks
    documents of one kind, those of all languages are taken; if there are none, or their
    scores are no higher than those of prose, the cut is the middle of the bounds.
    """
    share = F.col("sentence_share")
    kind = F.when(share < JUNK, "junk").when(share > PROSE, "prose")
    mean = lambda k: F.avg(F.when(kind == k, F.col("score")))
    rows = materialize(scores, "scores")
    by = rows.groupBy("lang_key").agg(mean("junk").alias("__junk"), mean("prose").alias("__prose"))  # one row a language
    every = rows.agg(mean("junk").alias("__all_junk"), mean("prose").alias("__all_prose"))  # one row
    known = rows.join(F.broadcast(by), "lang_key").crossJoin(F.broadcast(every))
    high, low = F.coalesce("__junk", "__all_junk"), F.coalesce("__prose", "__all_prose")
    place = F.when(high > low, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("score") - low) / (high - low)))).otherwise(0.5)
    return known.where(share < JUNK + (PROSE - JUNK) * place).select(*scores.columns)

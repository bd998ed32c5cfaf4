"""URL filter: host word segmentation and naive Bayes.

Concatenated names are split into words by a unigram model (Viterbi over the
best split of every prefix), learned from the words of all pages and URLs.
Words of host and path are scored by multinomial naive Bayes: the blocked class
is learned from example names (a parameter), smoothed by the allowed class,
which is the unigram model of the whole table.  Rules come first; the model
decides the rest.

The word table grows with the pages and stays on Spark: the substrings of each
distinct letter run of hosts and paths join it, those of a length that some
counted word has, so every counted word takes part in the split, and a run is
split once however many URLs hold it.  Only the blocked class, whose size is that of the examples,
is sent to the tasks.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import Scratch, Words, ascii_lower, lower_ascii, slices

# Letters of a batch of substrings.
BATCH_LETTERS = 1 << 20
# What a letter of an unknown word costs.
LETTER = 2.5
# Weight of the allowed class in the blocked one, in sizes of the examples, and
# the log odds of a page without words.
SMOOTHING = 20.0
# Words added to those of the pages; an example word has one in 10,000 of them.
PSEUDO_WORDS = 100_000
# An example word that the pages hardly use counts as this common.
RARE = 1e-4
PRIOR = -1.8

# Examples of names of unwanted sites, by topic.  One doubtful
# word is not enough for a verdict, so telling words stand in several names.
BLOCK_EXAMPLES = """
adult video adult cams porn tube porn sex sex cams xxx adult xxx tube sexy nude nude cams escort hentai erotic milf webcam escort hentai erotic milf
casino bets casino poker bets betting betting bonus poker roulette slots jackpot slots casino lottery win gambling gambling wager bookmaker bookmaker free spins
cheap pills pills pharmacy viagra cialis viagra pills cialis online pharmacy cheap meds meds tramadol tramadol steroids steroids weight loss drugs
spam farm spam bot link farm seo links backlinks backlinks seo spam clickbait clickbait traffic doorway
ads track ads tracker tracker tracking adserver ads adserver banner popup popup click affiliate affiliate doubleclick doubleclick pixel track
warez crack warez keygen keygen cracked cracked nulled nulled torrent torrent hack cheats serial
payday loans payday cash money fast easy rich scam crypto scam replica watches replica rolex malware malware phishing phishing fake
""".split()
# Words of ordinary names, so that they are known to the splitter.
ALLOW_EXAMPLES = """
www blog news wiki mail shop store home page site web forum docs help support learn school university library
science health travel food recipes music art history garden sports weather city local community open source
code developer data research journal book books magazine review museum times daily post press media example
""".split()


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits (of equal ones the
    first that blocks), null if none does."""
    order = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "block"))
    out = None
    for r in order:
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)  # log probability
    unknown: float = -12.0
    block: dict[str, float] = field(default_factory=dict)  # log odds of blocked against allowed
    block_unknown: float = 0.0
    prior: float = PRIOR
    counts: DataFrame | None = None  # word, n: where the words of a fitted model are
    whole: int = 1  # sum of the counts


def segment(name: str, model: Model) -> list[str]:
    """The most probable split of a name into words (letters only).  An unknown
    word costs more with every letter."""
    n, lengths = len(name), sorted({len(w) for w in model.words})
    best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
    run, since = -math.inf, 0  # the best split so far that ends in an unknown word, and where that begins
    for j in range(1, n + 1):
        if best[j - 1] + model.unknown > run:
            run, since = best[j - 1] + model.unknown, j - 1
        run -= LETTER
        best[j], back[j] = run, since
        for size in lengths:
            if size > j:
                break
            p = model.words.get(name[j - size:j])
            if p is not None and best[j - size] + p > best[j]:
                best[j], back[j] = best[j - size] + p, j - size
    out, j = [], n
    while j:
        out.append(name[back[j]:j])
        j = back[j]
    return out[::-1]


_LETTERS = re.compile(r"[^\W\d_]+")


def parts_of(host: str, path: str) -> list[str]:
    """Letter runs of a host (without its last label) and path."""
    name = host.rsplit(".", 1)[0] if "." in host else host
    return _LETTERS.findall(f"{name} {path.lower()}")


# Scripts, styles, tags and all else but letters; a '<' that opens no tag is one of the rest.
_NO_WORDS = r"(?is)<(?:script|style)\b.*?(?:</[^>]*>|\z)|<[^<>]*>|[^\pL<]+|<"


def count_words(pages: DataFrame) -> DataFrame:
    """``word, n`` over all paths and page texts without markup, letters only, a
    row per batch and word.  A page's own host is left out: a
    name must not become a word by being a name."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            texts = pc.fill_null(b.column("text"), "")
            texts = pc.replace_substring_regex(texts, _NO_WORDS, " ")
            words = Words(lower_ascii(texts), lower=False)
            n = np.bincount(words.codes, minlength=len(words.distinct))
            keep = n > 0
            yield pa.RecordBatch.from_arrays([words.distinct.filter(pa.array(keep)), pa.array(n[keep], pa.int64())], names=["word", "n"])

    host = host_of(F.col("url"))
    html = F.when(host != "", F.replace(F.col("html"), host, F.lit(" "))).otherwise(F.col("html"))
    text = F.concat_ws(" ", path_of(F.col("url")), html)
    return pages.select(text.alias("text")).mapInArrow(count, "word string, n long")


def fit(pages: DataFrame, block_examples: list[str] | None = None, allow_examples: list[str] | None = None) -> Model:
    """Learn the splitter and the allowed class from all of ``pages(url, html)``,
    the blocked class from the example names."""
    block_examples = BLOCK_EXAMPLES if block_examples is None else block_examples
    allow_examples = ALLOW_EXAMPLES if allow_examples is None else allow_examples
    spark, added = pages.sparkSession, PSEUDO_WORDS // 10_000
    examples = sorted({*block_examples, *allow_examples})
    own = spark.createDataFrame([(w, added) for w in examples], "word string, n long")
    counts = Scratch(spark, "urls").write(count_words(pages).union(own).groupBy("word").agg(F.sum("n").alias("n")), "words")
    whole = (counts.agg(F.sum("n")).first()[0] or 0) - added * len(examples) + PSEUDO_WORDS
    known = {r.word: r.n for r in counts.where(F.col("word").isin(examples)).collect()}
    model = Model(unknown=math.log(0.5 / whole), counts=counts, whole=whole)
    blocked = Counter(block_examples)
    size = sum(blocked.values())
    model.block_unknown = math.log(SMOOTHING / (1 + SMOOTHING))
    for w, n in blocked.items():
        p = max(known[w] / whole, RARE)
        model.block[w] = math.log((n / size + SMOOTHING * p) / (1 + SMOOTHING) / p)
    return model


def substrings(parts: DataFrame, lengths: list[int]) -> DataFrame:
    """``id, word``: the substrings of these lengths of ``parts(id, part)``, in
    batches of bounded size; one that recurs far apart in a part may come again."""

    def batch(rows: set[tuple[int, str]]) -> pa.RecordBatch:
        ids, words = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(words, pa.string())], names=["id", "word"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: set[tuple[int, str]] = set()
        held = 0
        for b in batches:
            for i, p in zip(b.column("id").to_pylist(), b.column("part").to_pylist(), strict=True):
                for size in lengths:
                    if size > len(p):
                        break
                    for at in range(len(p) - size + 1):
                        rows.add((i, p[at:at + size]))
                        held += size
                        if held >= BATCH_LETTERS:
                            yield batch(rows)
                            rows, held = set(), 0
        if rows:
            yield batch(rows)

    return parts.mapInArrow(cut, "id long, word string")


def split_parts(parts: DataFrame, model: Model) -> DataFrame:
    """``part, words`` for every row of ``parts(id, part)``, both distinct: the
    split by all words of ``model.counts``.  Only the lengths of words go to the
    driver: k of them take a table of at least k * k / 2 letters."""
    whole, unknown = model.whole, model.unknown

    @F.arrow_udf("array<string>")
    def split(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for names, known in columns:
            out = []
            for p, rows in zip(names.to_pylist(), known.to_pylist(), strict=True):
                out.append(segment(p, Model({r["word"]: math.log(r["n"] / whole) for r in rows or ()}, unknown)))
            yield pa.array(out, pa.list_(pa.string()))

    usable = model.counts.where((F.length("word") > 1) | (F.col("n") > whole / 1000))
    lengths = sorted(r[0] for r in usable.select(F.length("word")).distinct().collect())
    known = substrings(parts, lengths).join(usable, "word").groupBy("id").agg(F.collect_set(F.struct("word", "n")).alias("known"))
    return parts.join(known, "id", "left").select("part", split.asNondeterministic()(F.col("part"), F.col("known")).alias("words"))


def judge(pages: DataFrame, model: Model, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, words, block_score`` for every row of
    ``pages(page_id, url)``: the rule's verdict, else block where the odds of
    the words are above even.

    Null URLs and URLs without ``://`` have an empty host and path, no words
    and are allowed; a null id stays null; repeated rows are judged alike;
    other columns are ignored; an empty table gives an empty result.
    """

    block, block_unknown, prior = model.block, model.block_unknown, model.prior
    scratch = Scratch(pages.sparkSession, "urls")

    def odds(words: list[str]) -> float:
        x = prior + sum(block.get(w, block_unknown) for w in words)
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, x))))

    @F.arrow_udf("array<string>")
    def parts(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for host, path in columns:
            yield pa.array([parts_of(h, p) for h, p in zip(host.to_pylist(), path.to_pylist(), strict=True)], pa.list_(pa.string()))

    @F.arrow_udf("double")
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for words in columns:
            yield pa.array([odds(w) for w in words.to_pylist()], pa.float64())

    url = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    # Each table is written before a larger one joins it: adaptive execution
    # splits a hot host or part only where both sides of the join come from a shuffle.
    names = url.select("host", "path").distinct()
    names = scratch.write(names.select("*", F.posexplode(parts.asNondeterministic()(F.col("host"), F.col("path"))).alias("at", "part")), "names")
    runs = scratch.write(names.select("part").distinct().withColumn("id", F.monotonically_increasing_id()), "parts")
    split = scratch.write(split_parts(runs, model), "split")
    words = names.join(split, "part").groupBy("host", "path").agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("all"))
    words = words.select("host", "path", F.flatten(F.col("all.words")).alias("words"))
    scored = scratch.write(words.select("*", score.asNondeterministic()(F.col("words")).alias("score")), "scored")
    out = url.join(scored, ["host", "path"], "left").withColumn("r", rule_for(F.col("host"), F.col("path"), rules))
    block_score = F.coalesce("score", F.lit(odds([])))
    own = F.when(block_score > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", own).alias("verdict"),
                      F.coalesce("words", F.array().cast("array<string>")).alias("words"), block_score.alias("block_score"))

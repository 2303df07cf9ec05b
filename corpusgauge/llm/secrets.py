"""Secret scans in DataFrame operations: three patterns and a Markov likelihood ratio.

Patterns find labelled secrets. Of two character Markov models, one is of random strings: it is
fitted to these secrets, mixed with a uniform one. The other is of ordinary text, fitted to words:
runs of letters, digits and ``+/_=-`` too short to be judged, outside the labelled secrets. A longer
run that no pattern covers is judged, never a sample, so no secret vouches for itself; if it is far
likelier under the model of random strings, it is reported as well (kind ``markov``). In both
samples each distinct string counts once. Of a run that a pattern covers in part, each piece that
sticks out is judged. Positions are code points, ends exclusive.

A match's place follows from the gaps and matches before it: the pattern is anchored at the end of
the previous match, gaps and matches are pulled out as arrays, and a running sum gives the starts.

Defined results: null text counts as empty and has no spans; every input row gives one row, also
when ids are null or repeat; an empty table gives no rows; without labelled secrets the random model is
uniform; without ordinary words the models report nothing. Other columns are never read.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusgauge.durable import Steps

# The kinds in their order, their patterns (group 1 is the secret) and least lengths.
KINDS = ["assign", "access", "hex", "markov"]
PATTERNS = {
    "assign": r"""(?:(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""",
    "access": r"(AKIA[A-Z0-9]+)",
    "hex": r"([0-9a-f]{16,})",
}
LEAST = {"assign": 12, "access": 18, "hex": 16}
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"([A-Za-z0-9+/_=-]{%d,})"
#: Group 2: a whole run of at most so many characters, none of it in an ``assign`` match.
WORD = rf"(?<![A-Za-z0-9+/_=-])(?:[A-Za-z0-9+/_=-]*?{PATTERNS['assign']}|([A-Za-z0-9+/_=-]{{2,%d}})(?![A-Za-z0-9+/_=-]))"
#: Shares: of the uniform part in either model, and of the capitals that every ordinary pair also counts as.
UNIFORM = {"random": 0.75, "ordinary": 1 / 64}
CAPITALS = 1 / 16
#: A piece shorter than this needs the score of one this long.
LEAST_PIECE = 12
#: Characters that the distinct pairs of a longer piece must answer for: few enough for a random run over ten digits.
VARIED = 128
FOUND = "array<struct<gap:int,size:int,secret:string>>"


def found(text: Column, pattern: str) -> Column:
    """Gap before, length and secret of every match, in order; \\G keeps the search linear."""
    anchored = F.lit(rf"\G([\s\S]*?)({pattern})")
    parts = [F.regexp_extract_all(text, anchored, F.lit(group)) for group in (1, 2, 3)]
    zipped = F.transform(
        F.arrays_zip(*[part.alias(name) for part, name in zip(parts, "abc")]),
        lambda m: F.struct(F.length(m["a"]).alias("gap"), F.length(m["b"]).alias("size"), m["c"].alias("secret")),
    )
    return F.when(text.rlike(pattern), zipped).otherwise(F.array().cast(FOUND))


def _placed(rows: DataFrame, column: str) -> DataFrame:
    """(row, start, end, secret) of the matches in an array column."""
    matches = rows.filter(F.size(column) > 0).select("row", F.posexplode(column).alias("at", "m"))
    upto = Window.partitionBy("row").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("m.gap").cast("bigint") + F.col("m.size")).over(upto)
    return matches.select("row", end.alias("end"), F.col("m.size").alias("size"), F.col("m.secret").alias("secret")).select(
        "row", (F.col("end") - F.col("size")).alias("start"), "end", "secret"
    )


def pairs_of(text: Column) -> Column:
    """All adjacent pairs of characters."""
    return F.regexp_extract_all(text, F.lit("(?=(..))"), F.lit(1))


def _pair_counts(samples: DataFrame, column: str) -> DataFrame:
    """(pair, n): counts of adjacent characters, at most the square of the alphabet of them."""
    return samples.select(F.explode(pairs_of(F.col(column))).alias("pair")).groupBy("pair").agg(
        F.count(F.lit(1)).alias("n")
    )


def likelihood_ratios(random: dict[str, int], ordinary: dict[str, int], weight: float = 256.0) -> list[float]:
    """log2 p(b | a) under the random model minus under the ordinary one.

    p(b | a) = (n(ab) + weight * p(b)) / (n(a) + weight), where p(b) is add-one smoothed, mixed with
    a uniform model: a secret of another alphabet than the labelled ones stays likely, and a pair
    that ordinary words lack is no proof by itself. Words in capitals are ordinary as well. Entry
    ``len(ALPHABET) * index(a) + index(b)``; all are 0 without ordinary pairs.
    """
    if not ordinary:
        return [0.0] * len(ALPHABET) ** 2
    spelled = dict(ordinary)
    for pair, n in ordinary.items():
        if pair.upper() != pair:
            spelled[pair.upper()] = spelled.get(pair.upper(), 0) + CAPITALS * n
    tables = []
    for counts, even in ((random, UNIFORM["random"]), (spelled, UNIFORM["ordinary"])):
        after = {b: sum(counts.get(a + b, 0) for a in ALPHABET) for b in ALPHABET}
        total = sum(after.values()) + len(ALPHABET)
        table = []
        for a in ALPHABET:
            row = [counts.get(a + b, 0) + weight * (after[b] + 1) / total for b in ALPHABET]
            table += [math.log2((1 - even) * n / sum(row) + even / len(ALPHABET)) for n in row]
        tables.append(table)
    return [one - other for one, other in zip(*tables)]


def score(pairs: Column, ratios: list[float]) -> Column:
    """Sum of the ratios over an array of adjacent pairs (all in the alphabet)."""
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    place = lambda pair, at: F.instr(F.lit(ALPHABET), F.substr(pair, F.lit(at), F.lit(1))) - 1
    return F.aggregate(
        pairs,
        F.lit(0.0),
        lambda total, pair: total + F.get(table, place(pair, 1) * len(ALPHABET) + place(pair, 2)),
    )


def likelier_random(text: Column, ratios: list[float], bits_per_character: float) -> Column:
    """Whether ``text`` is likelier random by so many bits a character (those of LEAST_PIECE at least).

    The ratio over all pairs must reach that, and so must the ratio over the distinct pairs, which
    repetition (a ruled line) does not raise. A long text has fewer distinct pairs than characters,
    so these answer for VARIED characters at most.
    """
    length = F.greatest(F.length(text), F.lit(LEAST_PIECE))
    varied = score(F.array_distinct(pairs_of(text)), ratios) > bits_per_character * F.least(length, F.lit(VARIED))
    return varied & (score(pairs_of(text), ratios) > bits_per_character * length)


def ordinary_words(text: Column, least_candidate: int) -> Column:
    """Distinct runs shorter than a candidate that are not part of a labelled secret."""
    words = F.regexp_extract_all(text, F.lit(WORD % max(2, least_candidate - 1)), F.lit(2))
    labelled = f"{PATTERNS['access']}|{PATTERNS['hex']}"
    return F.filter(F.array_distinct(words), lambda word: (word != "") & ~word.rlike(labelled))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_candidate: int = 20,
    bits_per_character: float = 1.0,
) -> DataFrame:
    """Per row: row, id, spans (array of start, end, kind number from 1), sorted."""
    steps = Steps(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = steps.keep(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            *[found(text, pattern).alias(kind) for kind, pattern in PATTERNS.items()],
            found(text, CANDIDATE % least_candidate).alias("candidates"),
        )
    )
    words = docs.select(F.explode(ordinary_words(text, least_candidate)).alias("secret"))
    return _scan_rows(rows, words, steps, bits_per_character)


def _outside(candidates: DataFrame, base: DataFrame) -> DataFrame:
    """(row, start, end, secret) of the parts of candidates outside all base spans, in one sweep per row.

    Between two neighbouring ends of spans nothing changes: a piece is inside a candidate where one
    is open, and outside the base spans where none of them is open.
    """
    run = F.struct("start", "secret")
    none = F.lit(None).cast("struct<start:bigint,secret:string>")

    def ends(spans: DataFrame, opened: Column, candidate: int) -> DataFrame:
        edges = F.array(
            F.struct(F.col("start").alias("at"), F.lit(1).alias("step"), opened.alias("run")),
            F.struct(F.col("end").alias("at"), F.lit(-1).alias("step"), none.alias("run")),
        )
        return spans.select("row", F.inline(edges)).select(
            "row", "at", "run", (F.col("step") * candidate).alias("inside"), (F.col("step") * (1 - candidate)).alias("covered")
        )

    events = ends(candidates, run, 1).unionByName(ends(base, none, 0))
    # At one place, ends come before starts: the open candidate is the last one that started.
    order = Window.partitionBy("row").orderBy("at", "inside")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = events.select(
        "row",
        F.col("at").alias("start"),
        F.lead("at").over(order).alias("end"),
        F.sum("inside").over(upto).alias("inside"),
        F.sum("covered").over(upto).alias("covered"),
        F.last("run", ignorenulls=True).over(upto).alias("run"),
    ).filter("inside = 1 AND covered = 0 AND end > start")
    place = (F.col("start") - F.col("run.start") + 1).cast("int")
    text = F.substr(F.col("run.secret"), place, (F.col("end") - F.col("start")).cast("int"))
    return pieces.select("row", "start", "end", text.alias("secret"))


def _scan_rows(rows: DataFrame, words: DataFrame, steps: Steps, bits_per_character: float) -> DataFrame:
    base = None
    for number, kind in enumerate(PATTERNS, 1):
        one = _placed(rows, kind).filter(F.length("secret") >= LEAST[kind]).withColumn("kind", F.lit(number))
        base = one if base is None else base.unionByName(one)
    base = steps.keep(base)
    free = steps.keep(_outside(_placed(rows, "candidates"), base))
    # Both count tables are bounded by the square of the alphabet.
    counts = [
        {pair: n for pair, n in _pair_counts(sample, "secret").collect() if pair[0] in ALPHABET and pair[1] in ALPHABET}
        for sample in (base.select("secret").distinct(), words.distinct())
    ]
    ratios = likelihood_ratios(*counts)
    added = free.filter(likelier_random(F.col("secret"), ratios, bits_per_character))
    every = base.drop("secret").unionByName(added.drop("secret").withColumn("kind", F.lit(KINDS.index("markov") + 1)))
    spans = every.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    return rows.select("row", "id").join(spans, "row", "left").select(
        "row", "id", F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")).alias("spans")
    )


def spans_text(spans: Column) -> Column:
    """kind:start:end by start, then kind, joined by commas."""
    name = lambda s: F.get(F.array(*map(F.lit, KINDS)), s["kind"] - 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")


def report(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per kind, digest of the pattern spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"] <= len(PATTERNS))

    def count_of(number: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("bigint")

    counts = [count_of(number).alias(f"n_{kind}") for number, kind in enumerate(PATTERNS, 1)]
    return scanned.select(
        F.col("id").alias(id_col),
        *counts,
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by ``mark``; overlapping spans become one mark."""
    start = F.struct(F.lit("").alias("text"), F.lit(0).cast("bigint").alias("at"))

    def step(state: Column, s: Column) -> Column:
        gap = F.greatest(s["start"] - state["at"], F.lit(0))
        before = F.substr(text, (state["at"] + 1).cast("int"), gap.cast("int"))
        shown = F.when(s["start"] >= state["at"], F.concat(state["text"], before, F.lit(mark))).otherwise(state["text"])
        return F.struct(shown.alias("text"), F.greatest(s["end"], state["at"]).alias("at"))

    last = F.aggregate(spans, start, step)
    rest = F.substr(text, (last["at"] + 1).cast("int"), F.length(text))
    return F.when(F.size(spans) > 0, F.concat(last["text"], rest)).otherwise(text)

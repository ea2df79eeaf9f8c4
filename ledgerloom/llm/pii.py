"""Personal data: base patterns, and bootstrapped contextual extraction of what they miss.

Only DataFrame functions. Base spans of every text are seed entities. The words before a seed are lexical patterns; the
same words before something that is merely shaped like an identifier link that instance to the pattern. Rounds of two
joins score the graph: a pattern by the trust in what follows it, over all its occurrences in all texts; an instance by
the patterns that precede it. Patterns of high confidence bring the instances behind them in as new spans. The
contexts, edges and scores are narrow tables; texts are read once for spans and once to count patterns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.bind import computed_once, let
from ledgerloom.llm.common import hash_join_small, store

# The base patterns. A match is tried only where the plain pattern could begin or go on after a match, so
# that no run of characters is read more than once; groups are possessive, so that long runs take no stack.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
# Shapes that a discovered identifier may have, and the kinds they serve.
MAIL_SHAPE = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?(?:@|[(\[]at[)\]]) ?[A-Za-z0-9-]++(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]++)*+"
)
SIX_SHAPE = r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"
DIGIT_SHAPE = r"(?<![0-9A-Za-z@.+-])\(?[0-9][0-9 ()./-]{5,28}[0-9](?![0-9A-Za-z@])"
SHAPES = f"{MAIL_SHAPE}|{SIX_SHAPE}|{DIGIT_SHAPE}"

SPAN = "struct<kind:int,start:int,stop:int,value:string>"
CONTEXT_CHARS = 200
BLOCK = 256
LEAST_VALUES = 3
CONFIDENT = 0.5
ROUNDS = 3


def running(values: Column, plus: Callable[[Column, Column], Column], zero: int) -> Column:
    """For each item of an array of integers the ``plus`` of all items before it, from ``zero``.

    A fold copies the array that it grows at each step, so it sees one block only, or the totals of the blocks.
    """

    def fold(items: Column, first: Column) -> Column:
        start = F.struct(first.alias("at"), F.array().cast("array<int>").alias("seen"))
        return F.aggregate(
            items,
            start,
            lambda state, x: F.struct(plus(state["at"], x).alias("at"), F.concat(state["seen"], F.array(state["at"])).alias("seen")),
            lambda state: state["seen"],
        )

    def blocks(items: Column) -> Column:
        last = F.floor((F.size(items) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), last)), lambda b: F.slice(items, b * BLOCK + 1, BLOCK))

    def joined(cut: Column) -> Column:
        totals = F.transform(cut, lambda block: F.aggregate(block, F.lit(zero), plus))
        return F.flatten(F.zip_with(cut, fold(totals, F.lit(zero)), fold))

    return let(values, lambda items: let(blocks(items), joined))


def located(text: Column, pattern: str, found: Column) -> Column:
    """(start, stop, value) of each match, in code points, from the pieces between the matches."""
    both = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), found.alias("value"))

    def sized(pair: Column) -> Column:
        size = F.coalesce(F.length(pair["value"]), F.lit(0))
        return F.struct(F.length(pair["piece"]).alias("gap"), size.alias("size"), pair["value"].alias("value"))

    def place(pair: Column, at: Column) -> Column:
        begin = at + pair["gap"]
        return F.struct(begin.alias("start"), (begin + pair["size"]).alias("stop"), pair["value"].alias("value"))

    def placed(pairs: Column) -> Column:
        widths = F.transform(pairs, lambda pair: pair["gap"] + pair["size"])
        return F.zip_with(pairs, running(widths, lambda a, b: a + b, 0), place)

    return F.filter(let(F.transform(both, sized), placed), lambda s: s["value"].isNotNull())


def matches(text: Column, pattern: str, needs: str) -> Column:
    """All matches; texts without a character that every match holds are not searched."""
    all_matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(text.rlike(needs), all_matches).otherwise(F.array().cast("array<string>"))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(value: Column) -> Column:
    """The check digit rule on a string of at most 19 digits."""
    reverse = F.split(F.reverse(digits(value)), "")
    twice = F.transform(
        F.filter(reverse, lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, F.lit(9)).otherwise(F.lit(0))
        ),
    )
    return F.aggregate(twice, F.lit(0), lambda total, d: total + d) % 10 == 0


def holds(kind: int, value: Column) -> Column:
    """Whether a match of the kind's pattern is one of the kind."""
    if KINDS[kind] == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.try_cast("double") <= 255)
    if KINDS[kind] == "card":
        return F.length(digits(value)).between(14, 19) & passes_luhn(value)
    if KINDS[kind] == "phone":
        return F.length(digits(value)).between(10, 15)
    return F.lit(True)


def base_spans(docs: DataFrame) -> DataFrame:
    """Adds __base: spans of the base patterns, in the order of kinds."""
    patterns = {"email": (EMAIL, "@"), "ip": (IP, r"[0-9]\.[0-9]"), "card": (CARD, "[0-9]"), "phone": (PHONE, r"\+[0-9]")}
    found = computed_once(docs, **{f"__m{k}": matches(F.col("__text"), *patterns[n]) for k, n in enumerate(KINDS)})

    def spans(kind: int) -> Column:
        column = F.col(f"__m{kind}")
        placed = located(F.col("__text"), patterns[KINDS[kind]][0], column)
        good = F.filter(placed, lambda s: holds(kind, s["value"]))
        typed = F.transform(
            good, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["value"].alias("value"))
        )
        return F.when(F.size(column) > 0, typed).otherwise(F.array().cast(f"array<{SPAN}>"))

    joined = F.concat(*[spans(k) for k in range(len(KINDS))])
    return computed_once(found, __base=joined).drop(*[f"__m{k}" for k in range(len(KINDS))])


def cut(text: Column, size: int) -> Column:
    """A text in stretches of ``size`` code points, so that what stands at a position is found without counting from its start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def words_before(stretches: Column, start: Column, size: int) -> Column:
    """The last two words of letters before a position on its line, lower case, from the ``size`` characters before it.

    A word that these characters cut in two is left out. ``stretches`` is the text cut in steps of one character more.
    """
    step = size + 1
    block = F.floor(start / step).cast("int")
    earlier = F.coalesce(F.get(stretches, block - 1), F.lit(""))
    here = F.substr(F.coalesce(F.get(stretches, block), F.lit("")), F.lit(1), start % step)
    # One character more than the window tells whether its first word is whole.
    left = F.right(F.concat(earlier, here), F.lit(step))
    left = F.when(start > size, F.regexp_replace(left, r"^\p{L}+", "")).otherwise(left)
    line = F.substring_index(left, "\n", -1)
    words = F.split(F.lower(line), r"[^\p{L}]+", -1)
    return let(F.filter(words, lambda w: w != ""), lambda w: F.slice(w, F.greatest(F.lit(1), F.size(w) - 1), 2))


def patterns_of(words: Column) -> Column:
    """The contexts that words before a position make: the last one, the last two."""
    one = F.when(F.size(words) > 0, F.element_at(words, -1))
    two = F.when(F.size(words) > 1, F.array_join(words, " "))
    return F.filter(F.array(one, two), lambda p: p.isNotNull())


def clear_of(base: Column, placed: Column) -> Column:
    """The places that overlap no base span, as spans of kind -1: all in order of start, each with the furthest stop of
    the base spans before it and the least start of those behind it."""

    def span(s: Column, kind: Column) -> Column:
        return F.struct(s["start"].alias("start"), kind.alias("kind"), s["stop"].alias("stop"), s["value"].alias("value"))

    every = F.concat(F.transform(base, lambda s: span(s, s["kind"])), F.transform(placed, lambda s: span(s, F.lit(-1))))

    def clear(ordered: Column) -> Column:
        far = 2**31 - 1
        stops = F.transform(ordered, lambda s: F.when(s["kind"] < 0, F.lit(0)).otherwise(s["stop"]))
        starts = F.transform(F.reverse(ordered), lambda s: F.when(s["kind"] < 0, F.lit(far)).otherwise(s["start"]))
        before = running(stops, lambda a, b: F.greatest(a, b), 0)
        behind = F.reverse(running(starts, lambda a, b: F.least(a, b), far))
        checked = F.filter(
            F.arrays_zip(ordered.alias("span"), before.alias("before"), behind.alias("behind")),
            lambda c: (c["span"]["kind"] < 0) & (c["before"] <= c["span"]["start"]) & (c["span"]["stop"] <= c["behind"]),
        )
        return F.transform(checked, lambda c: F.struct(*[c["span"][n].alias(n) for n in ("kind", "start", "stop", "value")]))

    return let(F.sort_array(every), clear)


def scanned(docs: DataFrame, context_chars: int = CONTEXT_CHARS) -> DataFrame:
    """(doc_id, version, base, mentions): spans of each text, and what the bootstrap needs of it.

    A mention is a base span, or a stretch of an identifier's shape that overlaps none, with its contexts. kind is -1
    where the shape alone is known.
    """
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("__text"))
    own = base_spans(own)
    shaped = matches(F.col("__text"), SHAPES, r"[0-9@]|[(\[]at[)\]]")
    own = computed_once(own, __shaped=shaped)
    placed = F.when(F.size("__shaped") > 0, located(F.col("__text"), SHAPES, F.col("__shaped")))
    own = computed_once(own, __placed=F.coalesce(placed, F.array().cast("array<struct<start:int,stop:int,value:string>>")))
    loose = F.when(F.size("__placed") > 0, clear_of(F.col("__base"), F.col("__placed")))
    every = F.concat("__base", F.coalesce(loose, F.array().cast(f"array<{SPAN}>")))
    own = computed_once(own, __all=every)
    own = computed_once(own, __stretches=F.when(F.size("__all") > 0, cut(F.col("__text"), context_chars + 1)))
    mentions = F.transform(
        "__all",
        lambda s: F.struct(
            s["kind"].alias("kind"),
            s["start"].alias("start"),
            s["stop"].alias("stop"),
            s["value"].alias("value"),
            let(words_before(F.col("__stretches"), s["start"], context_chars), patterns_of).alias("contexts"),
        ),
    )
    version = F.xxhash64("__text").alias("version")
    return own.select("doc_id", version, F.col("__base").alias("base"), mentions.alias("mentions"))


def kinds_of_shape(value: Column) -> Column:
    """The kinds that a loosely shaped value may be."""
    count = F.length(digits(value))
    return F.when(value.rlike(r"@|[(\[]at[)\]]"), F.array(F.lit(0))).when(
        value.contains(":"), F.array(F.lit(1))
    ).otherwise(
        F.filter(
            F.array(F.when(count.between(12, 19), F.lit(2)), F.when(count.between(7, 15), F.lit(3))), lambda k: k.isNotNull()
        )
    )


def context_totals(docs: DataFrame, contexts: DataFrame) -> DataFrame:
    """How often each context (one or two words of letters on a line) occurs in all texts: (context, total)."""
    lines = docs.select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line"))
    words = lines.select(F.filter(F.split(F.lower("line"), r"[^\p{L}]+", -1), lambda w: w != "").alias("w"))
    words = computed_once(words.select("w"), ws=F.col("w")).select("ws")
    pairs = F.expr(
        "transform(sequence(1, greatest(1, size(ws) - 1)), i -> IF(size(ws) > 1, concat(ws[i - 1], ' ', ws[i]), NULL))"
    )
    every = words.where(F.size("ws") > 0).select(F.explode(F.concat("ws", pairs)).alias("context"))
    return every.join(contexts, "context").groupBy("context").agg(F.count("*").alias("total"))


def confident_patterns(
    docs: DataFrame, seen: DataFrame, least_values: int, confident: float, rounds: int
) -> DataFrame:
    """(context, kind, precision) of patterns whose instances are trusted, after rounds over the graph.

    ``seen`` holds mentions, one row per context: kind (or null), kinds, value, context. A pattern needs
    ``least_values`` different seed values, so copies of one text make none.
    """
    seeds = seen.where("seed").groupBy("context", "kind").agg(F.count_distinct("value").alias("values"))
    supported = store(seeds.where(F.col("values") >= least_values).select("context", "kind"), "pii-contexts")
    totals = store(context_totals(docs, supported.select("context").distinct()), "pii-totals")
    edges = seen.groupBy("context", "kind", "value").agg(F.count("*").alias("times"), F.max("seed").alias("seed"))
    edges = edges.join(supported, ["context", "kind"]).join(totals, "context")
    edges = store(edges, "pii-edges")
    trust = edges.where("seed").select("kind", "value").distinct().withColumn("trust", F.lit(1.0))
    for _ in range(rounds):
        known = edges.join(trust, ["kind", "value"], "left").fillna(0.0, ["trust"])
        scores = known.groupBy("context", "kind").agg(
            (F.sum(F.col("trust") * F.col("times")) / F.first("total")).alias("precision")
        )
        scores = store(scores, "pii-patterns")
        spread = edges.join(scores.where(F.col("precision") >= confident), ["context", "kind"])
        doubt = F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.least(F.lit(1.0), F.col("precision")))))
        instance = spread.groupBy("kind", "value").agg(F.max("seed").alias("seed"), doubt.alias("doubt"))
        trust = instance.select(
            "kind", "value", F.when(F.col("seed"), F.lit(1.0)).otherwise(1 - F.exp("doubt")).alias("trust")
        )
        rest = edges.where("seed").select("kind", "value").distinct().withColumn("trust", F.lit(1.0))
        trust = trust.unionByName(rest).groupBy("kind", "value").agg(F.max("trust").alias("trust"))
        trust = store(trust, "pii-trust")
    return scores.where(F.col("precision") >= confident)


def find(
    docs: DataFrame,
    least_values: int = LEAST_VALUES,
    confident: float = CONFIDENT,
    rounds: int = ROUNDS,
    context_chars: int = CONTEXT_CHARS,
) -> DataFrame:
    """Spans of personal data per document: (doc_id, base, found), arrays of (kind, start, stop, value).

    base has the matches of the base patterns, found those and what confident patterns add; positions are code points,
    ends exclusive. kind numbers email, ip, card, phone. An addition never overlaps a base span; of two kinds for one
    stretch the more precise pattern's counts, then the first. Contexts are whole words on the line of an identifier
    within the ``context_chars`` characters before it; the work on a text grows with its length. Null text is empty and has no span. Repeated rows come
    back as often as they came, with the same spans. Other columns are not read; an empty table gives an empty result.
    """
    spans = store(scanned(docs, context_chars), "pii-spans")
    mentions = spans.select("doc_id", "version", F.inline("mentions")).distinct()
    seed = F.col("kind") >= 0
    kinds = F.when(seed, F.array("kind")).otherwise(kinds_of_shape(F.col("value")))
    seen = mentions.withColumn("seed", seed).withColumn("kind", F.explode(kinds)).withColumn(
        "context", F.explode("contexts")
    )
    patterns = confident_patterns(docs, seen, least_values, confident, rounds)
    new = seen.where("NOT seed").join(patterns, ["context", "kind"])
    best = new.groupBy("doc_id", "version", "start", "stop").agg(
        F.max(F.struct(F.col("precision"), (-F.col("kind")).alias("order"), F.col("value"))).alias("top")
    )
    span = F.struct((-F.col("top.order")).cast("int").alias("kind"), "start", "stop", F.col("top.value").alias("value"))
    added = best.groupBy("doc_id", "version").agg(F.collect_list(span).alias("added"))
    added = added.toDF("__doc", "__version", "added")
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("version") == F.col("__version"))
    joined = hash_join_small(spans.select("doc_id", "version", "base"), added, same, "left")
    both = F.concat("base", F.coalesce(F.col("added").cast(f"array<{SPAN}>"), F.array().cast(f"array<{SPAN}>")))
    return joined.select("doc_id", "base", both.alias("found"))


def count_of(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """kind:start:end of each span, by start, then kind, joined by commas."""
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop")))
    )
    names = F.array(*map(F.lit, KINDS))
    text = F.transform(ordered, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["stop"]))
    return F.array_join(text, ",")

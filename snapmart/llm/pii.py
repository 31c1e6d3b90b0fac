"""Personal data by bootstrapped contextual extraction, made of DataFrame functions only.

Base patterns find e-mail addresses, IP addresses, card and phone numbers. They are the seeds of a bootstrap: the words
around a seed are lexical patterns, the same patterns stand beside other identifier-shaped tokens, and the two form a
graph of patterns and instances. Rounds of joins score it: a pattern counts for a kind as far as its instances are of
that kind, an instance as far as its patterns are. Unseen instances of high score become spans of that kind.

Spans count code points, the end excluded. They come from one split of a text at its matches, so positions are sums of
lengths and no text is searched twice. The patterns are possessive: no input makes them backtrack over a long run, and
texts without a digit, an at sign or a plus are not matched at all.

Defined results: a null text counts as empty and has no spans; hashes of no spans are those of the empty string. A span
found by context never touches another one and is plausible for its kind; of discovered spans that overlap, the
longest stays, or of equally long ones the first.
Repeated rows get equal spans, null ids stay null, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm.store import fresh, materialize, numbered, small_enough

KINDS = ("email", "ip", "card", "phone")

# The patterns as given, with possessive quantifiers where a match cannot end sooner, and with a look-behind where a
# start inside a run cannot match unless its beginning does.
LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Tokens shaped like an identifier: six characters or more, three digits or more among them.
IDENTIFIER = r"(?<![^\x20\x09-\x0D])(?=(?:[^\x20\x09-\x0D0-9]*+[0-9]){3})[^\x20\x09-\x0D]{6,}+"
#: Groups of digits with blanks between them, and e-mail addresses whose signs are written out.
GROUP = r"\(?[0-9][0-9()./-]*+"
HOST = r"[A-Za-z0-9-]{1,63}+"
SPACED = (
    r"(?<![^\x20\x09-\x0D\[<{\"':])(?:"
    rf"{LOCAL}{{1,64}}+(?: ?[\[({{<] ?(?i:at|@) ?[\])}}>] ?| (?i:at) ){HOST}(?:(?:\.| ?[\[({{<] ?(?i:dot|\.) ?[\])}}>] ?| (?i:dot) ){HOST}){{1,8}}"
    rf"|\+?{GROUP}(?:\x20{GROUP}){{1,7}}(?=[.,;:!?)\]>}}\"']*+(?:[\x20\x09-\x0D]|$)))"
)
#: Where SPACED or IDENTIFIER can match at all.
CANDIDATE = r"(?i)[0-9]|[\[({<\x20](?:at|@)[\])}>\x20]"
#: Signs around a token; a bracket that closes inside is part of it.
HEAD = r"^(?:[\[<{\"']|\((?![0-9+]++\)))+"
EDGE = HEAD + r"|[.,;:!?)\]>}\"']+$"

ROUNDS = 3
#: Score a pattern and an instance need, and the different seeds a pattern must stand beside.
MIN_SCORE = 0.8
MIN_SEEDS = 5
#: Unseen instances a pattern is taken to have beyond the ones found.
PRIOR = 1.0
#: Characters of the text beside an instance in which its words are looked for.
REACH = 64

#: Documents with spans that are broadcast at most when texts are redacted; beyond that they are joined.
BROADCAST_ROWS = 100_000

SPAN = "struct<start:int,end:int,value:string,before:string,after:string>"


def once(value: Column, made: Callable[[Column], Column]) -> Column:
    """What is made of a value that is computed once; named in a lambda itself, it would be for every element."""
    return F.get(F.transform(F.array(value), made), F.lit(0))


def blocks(items: Column) -> Column:
    """The items in order, in blocks of about the root of their number; one empty block if there are none."""
    width = F.greatest(F.ceil(F.sqrt(F.size(items))), F.lit(1)).cast("int")
    firsts = F.sequence(F.lit(1), F.greatest(F.size(items), F.lit(1)), width)
    return F.transform(firsts, lambda first: F.slice(items, first, width))


def running(numbers: Column, add: Callable[[Column, Column], Column], start: int = 0) -> Column:
    """The running total (greatest, least) of integers. Arrays are copied when they grow: so first over the blocks, then
    within each."""
    def within(block: Column, before: Column) -> Column:
        state = F.struct(before.alias("at"), F.array().cast("array<int>").alias("all"))

        def step(state: Column, number: Column) -> Column:
            at = add(state["at"], number)
            return F.struct(at.alias("at"), F.array_append(state["all"], at).alias("all"))

        return F.aggregate(block, state, step, lambda state: state["all"])

    def whole(cut: Column) -> Column:
        totals = F.transform(cut, lambda block: F.aggregate(block, F.lit(start), lambda at, number: add(at, number)))
        carried = lambda ends, i: F.when(i > 0, F.get(ends, i - 1)).otherwise(F.lit(start))
        return once(
            within(totals, F.lit(start)),
            lambda ends: F.flatten(F.transform(cut, lambda block, i: within(block, carried(ends, i)))),
        )

    return once(blocks(numbers), whole)


def found(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with their positions and the text beside them."""
    parts = F.struct(
        F.split(text, pattern, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(pattern), 0).alias("values")
    )

    def spans(own: Column) -> Column:
        before = lambda i: F.get(own["pieces"], i)
        lengths = F.transform(own["values"], lambda value, i: F.length(before(i)) + F.length(value))
        return once(running(lengths, lambda at, n: at + n), lambda ends: F.transform(own["values"], lambda value, i: F.struct(
            (F.get(ends, i) - F.length(value)).alias("start"),
            F.get(ends, i).alias("end"),
            value.alias("value"),
            F.right(before(i), F.lit(REACH)).alias("before"),
            F.substring(before(i + 1), 1, REACH).alias("after"),
        )))

    return once(parts, spans)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits pass the check; every second one from the right counts double."""
    def share(at: Column) -> Column:
        digit = F.substring(number, at, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return F.when((F.length(number) - at) % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda sum_, at: sum_ + share(at)) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        number = F.regexp_replace(value, "[ -]", "")
        return F.when(F.length(number).between(13, 19), luhn(number)).otherwise(False)
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    sign = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}.get(kind, text.rlike("[0-9]"))
    spans = F.filter(found(text, PATTERNS[kind]), lambda span: valid(kind, span["value"]))
    return F.when(sign, spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def identifiers(text: Column) -> Column:
    """Identifier-shaped tokens and groups of them, without the punctuation around them."""
    def trimmed(span: Column) -> Column:
        start = span["start"] + F.length(F.regexp_extract(span["value"], HEAD, 0))
        value = F.regexp_replace(span["value"], EDGE, "")
        return F.struct(
            start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"),
            span["before"].alias("before"), span["after"].alias("after"),
        )

    both = F.concat(F.transform(found(text, IDENTIFIER), trimmed), F.transform(found(text, SPACED), trimmed))
    return F.when(text.rlike(CANDIDATE), both).otherwise(F.array().cast(f"array<{SPAN}>"))


def word(text: Column, pattern: str) -> Column:
    """A word beside an instance, lower-cased, without digits and signs; empty at the edge of the text."""
    return F.regexp_replace(F.lower(F.regexp_extract(text, pattern, 1)), r"[0-9]+|^\W+|\W+$", "")


def contexts(before: Column, after: Column) -> Column:
    """Lexical patterns around an instance: two words before, and the words on both sides."""
    last = word(before, r"(\S+)\s*$")
    second = word(before, r"(\S+)\s+\S+\s*$")
    first = word(after, r"^\s*(\S+)")
    patterns = F.array(F.concat(F.lit("before "), second, F.lit(" "), last), F.concat(F.lit("around "), last, F.lit(" "), first))
    return F.when(last != "", patterns).otherwise(F.array().cast("array<string>"))


def plausible(kind: Column, value: Column) -> Column:
    """Whether a value that no pattern matches can be of the kind at all; its contexts say whether it is."""
    n = F.length(digits(value))
    numeric = ~value.rlike("[A-Za-z]") & (2 * n >= F.length(value))
    email = value.rlike(r"(?i)(?:@|[\[({<\x20]at[\])}>\x20]).*[a-z]") & (F.length(value) <= 320)
    ip = value.rlike(r"^[0-9]+(?:[^0-9A-Za-z]+[0-9]+){3}(?:[:/][0-9]+)?$|^[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}$")
    return (
        F.when(kind == "email", email).when(kind == "ip", ip)
        .when(kind == "card", numeric & n.between(8, 24)).otherwise(numeric & n.between(3, 20))
    )


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: row_id, doc_id, the base spans of each kind and the identifier-shaped tokens."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = fresh(docs, "row")
    return numbered(docs, row).select(
        F.col(row).alias("row_id"),
        F.col(id_col).alias("doc_id"),
        *[base_spans(text, kind).alias(kind) for kind in KINDS],
        identifiers(text).alias("tokens"),
    )


def untouched(marked: Column) -> Column:
    """Spans that have a kind, and of those without one, the ones that touch none of the others.

    In the order of starts, such a span must begin after all ends before it and end before the next start."""
    ordered = F.array_sort(F.transform(marked, lambda m: F.struct(
        m["span"]["start"].alias("at"), m["kind"].isNull().alias("free"), m["kind"].alias("kind"), m["span"].alias("span"),
    )))

    def free(rows: Column) -> Column:
        ends = running(F.transform(rows, lambda m: F.when(m["free"], 0).otherwise(m["span"]["end"])), F.greatest)
        none = 2**31 - 1
        starts = F.transform(F.reverse(rows), lambda m: F.when(m["free"], none).otherwise(m["at"]))
        around = F.struct(ends.alias("ends"), F.reverse(running(starts, F.least, none)).alias("starts"))
        clear = lambda own, m, i: (F.get(own["ends"], i) <= m["at"]) & (F.get(own["starts"], i) >= m["span"]["end"])
        return once(around, lambda own: F.filter(rows, lambda m, i: ~m["free"] | clear(own, m, i)))

    return once(ordered, free)


def mentions(scanned: DataFrame) -> DataFrame:
    """Seeds with their kind, and identifier-shaped tokens that touch no seed, with a null kind.

    A row for each pattern around them, or one with a null pattern: a value discovered elsewhere counts there too."""
    named = lambda kind: F.transform(F.col(kind), lambda span: F.struct(F.lit(kind).alias("kind"), span.alias("span")))
    base = F.flatten(F.array(*map(named, KINDS)))
    tokens = F.filter("tokens", lambda token: token["end"] > token["start"])
    unseen = F.transform(tokens, lambda token: F.struct(F.lit(None).cast("string").alias("kind"), token.alias("span")))
    rows = scanned.select("row_id", F.explode(untouched(F.concat(base, unseen))).alias("m"))
    return rows.select(
        "row_id",
        F.col("m.kind").alias("kind"),
        F.col("m.span.start").alias("start"),
        F.col("m.span.end").alias("end"),
        F.col("m.span.value").alias("value"),
        F.explode_outer(contexts(F.col("m.span.before"), F.col("m.span.after"))).alias("pattern"),
    )


def score_patterns(edges: DataFrame, instances: DataFrame) -> DataFrame:
    """pattern, kind, score: the share of a pattern's instances that are of the kind."""
    totals = edges.select("pattern", "value").distinct().groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    sums = edges.select("pattern", "value").distinct().join(instances, "value").groupBy("pattern", "kind").agg(
        F.sum("score").alias("weight"), F.sum(F.col("seed").cast("int")).alias("seeds")
    )
    share = F.col("weight") / (F.col("n") + PRIOR)
    return sums.join(totals, "pattern").filter(F.col("seeds") >= MIN_SEEDS).select(
        "pattern", "kind", F.round(share, 6).alias("score")
    )


def discovered(graph: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """value, kind of the unseen instances that reach the score. graph: kind, value, pattern, distinct."""
    seeds = graph.filter("kind is not null").select("value", "kind").distinct()
    seeds = seeds.select("value", "kind", F.lit(1.0).alias("score"), F.lit(True).alias("seed"))
    unseen = graph.filter("kind is null").select("value", "pattern").distinct()
    instances = seeds
    for _ in range(rounds):
        patterns = score_patterns(graph, instances)
        # Noisy or: an instance is of a kind unless all its patterns are wrong about it.
        doubt = F.sum(F.log1p(-F.least("score", F.lit(0.999))))
        learned = unseen.join(patterns, "pattern").groupBy("value", "kind").agg((1 - F.exp(doubt)).alias("score"))
        learned = learned.select("value", "kind", F.round("score", 6).alias("score"), F.lit(False).alias("seed"))
        instances = materialize(seeds.unionByName(learned.join(seeds.select("value").distinct(), "value", "left_anti")))
    sure = instances.filter(~F.col("seed") & (F.col("score") >= MIN_SCORE))
    best = sure.groupBy("value").agg(F.max(F.struct("score", "kind")).alias("best")).select("value", "best.kind")
    return best.filter(plausible(F.col("kind"), F.col("value")))


def placed(kind: str, order: int) -> Column:
    """The base spans of a kind with its place in the order of kinds."""
    return F.transform(
        F.col(kind),
        lambda s: F.struct(
            F.lit(order).alias("o"), s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per document: row_id, doc_id, base and all spans as arrays of (kind, start, end) by kind, then start."""
    scanned = materialize(scan(docs, id_col, text_col))
    found_ = materialize(mentions(scanned))
    graph = found_.filter("pattern is not null").select("kind", "value", "pattern").distinct()
    new = discovered(graph, rounds)
    extra = found_.filter("kind is null").drop("kind").join(new, "value")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    extra = extra.select("row_id", order.alias("o"), "kind", "start", "end").repartition("row_id").distinct()
    # Only spans of one run of overlapping ones are compared with each other.
    text = Window.partitionBy("row_id").orderBy("start", "end")
    begins = F.col("start") >= F.max("end").over(text.rowsBetween(Window.unboundedPreceding, -1))
    extra = extra.withColumn("begins", F.coalesce(begins, F.lit(True)).cast("int"))
    extra = extra.withColumn("cluster", F.sum("begins").over(text.rowsBetween(Window.unboundedPreceding, 0)))
    extra = extra.groupBy("row_id", "cluster").agg(F.collect_list(F.struct("o", "start", "end", "kind")).alias("all"))
    size = lambda s: s["end"] - s["start"]
    above = lambda other, s: (size(other) > size(s)) | (size(other) == size(s)) & (other["start"] < s["start"])
    longest = F.filter("all", lambda s: ~F.exists("all", lambda other: (other["start"] < s["end"]) & (s["start"] < other["end"])
        & above(other, s)))
    extra = extra.groupBy("row_id").agg(F.flatten(F.collect_list(longest)).alias("extra"))
    base = F.flatten(F.array(*[placed(kind, o) for o, kind in enumerate(KINDS, 1)]))
    spans = scanned.select("row_id", "doc_id", base.alias("base")).join(extra, "row_id", "left")
    none = F.array().cast("array<struct<o:int,start:int,end:int,kind:string>>")
    everything = F.array_sort(F.concat(F.col("base"), F.coalesce("extra", none)))
    plain = lambda spans: F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return spans.select("row_id", "doc_id", plain(F.array_sort("base")).alias("base"), plain(everything).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    texts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(texts, ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; of spans that overlap, the first is widened."""
    sorted_ = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def block(own: Column) -> Column:
        # Its spans are looked up in its part of the text, not in all of it.
        first = F.get(own, F.lit(0))["at"]
        gap = lambda part, s: F.substring(part, s["at"] - first + 1, F.greatest(s["start"] - s["at"], F.lit(0)))
        mark = lambda s: F.when(s["start"] >= s["at"], F.concat(F.lit("<"), s["kind"], F.lit(">"))).otherwise("")
        return once(
            F.substring(text, first + 1, F.element_at(own, -1)["end"] - first),
            lambda part: F.array_join(F.transform(own, lambda s: F.concat(gap(part, s), mark(s))), ""),
        )

    def written_out(own: Column) -> Column:
        at = lambda i: F.when(i > 0, F.get(own["ends"], i - 1)).otherwise(0)
        placed = F.transform(own["spans"], lambda s, i: F.struct(
            at(i).alias("at"), s["start"].alias("start"), F.get(own["ends"], i).alias("end"), s["kind"].alias("kind"),
        ))
        rest = F.substring(text, F.element_at(own["ends"], -1) + 1, F.length(text))
        return F.concat(once(blocks(placed), lambda cut: F.array_join(F.transform(cut, block), "")), rest)

    def ended(own: Column) -> Column:
        ends = running(F.transform(own, lambda s: s["end"]), F.greatest)
        return once(F.struct(own.alias("spans"), ends.alias("ends")), written_out)

    whole = once(sorted_, ended)
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def redact_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their personal data replaced; docs must be a stored table."""
    row, marked = fresh(docs, "row"), fresh(docs, "spans")
    spans = personal_data(docs, id_col, text_col).filter(F.size("spans") > 0)
    spans = small_enough(materialize(spans.select(F.col("row_id").alias(row), F.col("spans").alias(marked))), BROADCAST_ROWS)
    joined = numbered(docs, row).join(spans, row, "left")
    text = F.when(F.col(marked).isNotNull(), redacted(F.col(text_col), F.col(marked))).otherwise(F.col(text_col))
    return joined.withColumn(text_col, text).select(*docs.columns)

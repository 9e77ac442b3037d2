"""Personal data by weak supervision, in DataFrame functions only.

Patterns propose spans of four kinds.  Labelers vote on each: the strict rule of the kind
(address parts, check digit, number of digits), a gazetteer (endings of domains, reserved
address ranges, issuers' and countries' first digits), the words around, and whether the
span stands alone.  Expectation-maximisation estimates for every kind how reliable each
labeler is; it needs only the counts of vote patterns, of which there are at most
4 * 3**4.  The posteriors then train the final span classifier, a linear one over hashed
features: the shape of the match and the words and signs beside it, not the votes but for
the strict rule.  Spans that pass the strict rule always stay; the classifier adds others.

Texts are read once.  Matches go with their surroundings to the shared folder, and
positions are running sums over the matches of one text; patterns are written so that no
text, however long its runs, makes them backtrack more than once.

Defined results: a null text is empty; positions count code points, ends are exclusive;
repeated rows each give a row; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicmart.llm.common import shielded, staged

KINDS = ("email", "ip", "card", "phone")
ACCEPTED = 0.9
ROUNDS = 50
BUCKETS = 1024
SMOOTHING = 20.0
BLOCK = 1024
_AROUND = 40

# Patterns: (name, kind, what a text must hold, pattern).  ``\G`` is the end of the match
# before: a run of signs is tried from its start or from there, never from its middle.
_PATTERNS = (
    (
        "email",
        "email",
        "@",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    ),
    ("ip", "ip", "[0-9]", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", "card", "[0-9]", r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", "phone", r"\+", r"\+[0-9][\x20().0-9-]+[0-9]"),
    (
        "spelled",
        "email",
        r"(?i)\bdot\b",
        r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+(?: at | ?\(at\) ?| ?\[at\] ?)[a-z0-9-]{1,63}+"
        r"(?:(?: dot | ?\(dot\) ?| ?\[dot\] ?)[a-z0-9-]{1,63}+){1,4}+",
    ),
    ("local", "phone", "[0-9]", r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])"),
)

# What the gazetteers and the context labeler know.
ENDINGS = ("com", "net", "org", "edu", "gov", "io", "info", "de", "fr", "es", "uk", "eu", "us", "ca", "ch", "at", "it")
RESERVED = r"^(?:0|10|127|169\.254|172\.(?:1[6-9]|2[0-9]|3[01])|192\.168|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|36|38|6011|65|62)"
COUNTRIES = r"^(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
NEAR = {
    "email": r"(?i)mail|contact|write|contacto|correo|courriel|kontakt|schreib",
    "ip": r"(?i)\bip\b|server|host|address|login|adresse|direcci",
    "card": r"(?i)card|visa|credit|pay|carte|karte|tarjeta",
    "phone": r"(?i)phone|call|tel\b|tel[ée.:]|mobile|fax|cell|anruf|llam|appel",
}
AGAINST = r"(?i)version|\bv$|release|order|isbn|serial|ticket|build|part no"


def _matches(text: Column, needed: str, pattern: str) -> Column:
    holds = text.contains(needed) if needed == "@" else text.rlike(needed)
    return F.when(holds, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def candidates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row_id, doc_id, text_hash) of all rows, and every match of every pattern.

    The matches: (row_id, doc_id, text_hash, pattern, kind, start, end, match, before, after).
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), text.alias("text"))
    rows = rows.select("*", *[_matches(F.col("text"), n, p).alias(f"m_{name}") for name, _, n, p in _PATTERNS])

    def placed(name: str, pattern: str) -> Column:
        found = F.col(f"m_{name}")
        gaps = F.split("text", pattern, -1)
        # One struct of arrays per pattern; gaps are kept as lengths and short surroundings.
        return F.when(
            F.size(found) > 0,
            F.arrays_zip(
                found.alias("match"),
                F.transform(
                    gaps,
                    lambda g: F.struct(
                        F.char_length(g).alias("gap"),
                        F.substring(g, -_AROUND, _AROUND).alias("before"),
                        F.substring(g, 1, _AROUND).alias("after"),
                    ),
                ).alias("side"),
            ),
        )

    rows = rows.select(
        "doc_id",
        "text_hash",
        F.monotonically_increasing_id().alias("row_id"),
        *[placed(name, p).alias(name) for name, _, _, p in _PATTERNS],
    )
    rows = staged(rows, "matches")
    # After the last match stands one more gap; it gives the last match its right side.
    ordered = Window.partitionBy("row_id", "pattern").orderBy("place")
    each = [
        rows.where(F.col(name).isNotNull()).select(
            "row_id",
            "doc_id",
            "text_hash",
            F.lit(name).alias("pattern"),
            F.lit(kind).alias("kind"),
            F.posexplode(name).alias("place", "m"),
        )
        for name, kind, _, _ in _PATTERNS
    ]
    every = each[0]
    for more in each[1:]:
        every = every.unionByName(more)
    every = every.select("row_id", "doc_id", "text_hash", "pattern", "kind", "place", "m.match", "m.side")
    size = F.coalesce(F.char_length("match"), F.lit(0))
    end = F.sum(F.col("side.gap") + size).over(ordered)
    found = every.select(
        "*", end.alias("end"), F.lead("side.after").over(ordered).alias("after")
    ).where("match IS NOT NULL")
    found = found.select(
        "row_id", "doc_id", "text_hash", "pattern", "kind",
        (F.col("end") - F.char_length("match")).alias("start"), "end", "match",
        F.col("side.before").alias("before"), F.coalesce("after", F.lit("")).alias("after"),
    )
    return rows.select("row_id", "doc_id", "text_hash"), found


# ---- labelers ----------------------------------------------------------------------------


def _luhn(digits: Column) -> Column:
    """Whether the check digit fits."""
    backwards = F.split(F.reverse(digits), "")
    values = F.transform(F.filter(backwards, lambda d: d != ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        (d.cast("int") * 2) % 10 + F.floor(d.cast("int") * 2 / 10).cast("int")
    ))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def _strict(kind: Column, match: Column, digits: Column) -> Column:
    """Whether the match is of its kind by rule; decides which spans stay in any case."""
    parts = F.split(match, r"\.")
    small = F.forall(parts, lambda p: (F.char_length(F.ltrim(p, F.lit("0"))) <= 3) & (
        F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255
    ))
    n = F.char_length(digits)
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", small)
        .when(kind == "card", n.between(16, 19) & F.when(n.between(16, 19), _luhn(digits)))
        .otherwise(n.between(8, 15))
    )


def votes(found: DataFrame) -> DataFrame:
    """Add ``strict`` and the votes of the labelers: 1 for, 0 against, -1 neither."""
    kind, match, pattern = F.col("kind"), F.col("match"), F.col("pattern")
    digits = F.regexp_replace("match", "[^0-9]", "")
    found = found.withColumn("digits", digits)
    digits = F.col("digits")
    base = pattern.isin(*KINDS)
    strict = base & _strict(kind, match, digits)
    known = (
        F.when(kind == "email", F.lower(F.regexp_extract(match, r"([A-Za-z0-9-]+)$", 1)).isin(*ENDINGS))
        .when(kind == "ip", ~match.rlike(RESERVED))
        .when(kind == "card", digits.rlike(ISSUERS))
        .when(pattern == "local", digits.rlike("^[2-9]"))
        .otherwise(digits.rlike(COUNTRIES))
    )
    near = F.lit(False)
    for name, words in NEAR.items():
        near = F.when(kind == name, F.col("before").rlike(words)).otherwise(near)
    alone = ~F.col("before").rlike(r"[\p{L}0-9_-]$") & ~F.col("after").rlike(r"^(?:[\p{L}0-9_-]|\.[0-9])")
    return found.withColumns(
        {
            "strict": strict,
            "v_rule": F.when(base, strict.cast("int")).otherwise(-1),
            "v_known": F.coalesce(known.cast("int"), F.lit(0)),
            "v_near": F.when(F.col("before").rlike(AGAINST), 0).when(near, 1).otherwise(-1),
            "v_alone": alone.cast("int"),
        }
    )


LABELERS = ("v_rule", "v_known", "v_near", "v_alone")

# What a labeler is taken for before any votes are seen: P(vote for | not personal) and
# P(vote for | personal).  A gazetteer entry or a span that stands alone says little, since
# nearly everything has it; the check digit and the words around say more.
BELIEFS = ((0.3, 0.95), (0.6, 0.9), (0.1, 0.9), (0.7, 0.95))
ANCHOR = 0.25


def reliabilities(
    patterns: list[tuple[tuple[int, ...], int]],
    rounds: int = ROUNDS,
    beliefs: tuple[tuple[float, float], ...] | None = None,
    anchor: float = ANCHOR,
) -> tuple[float, list[list[list[float]]]]:
    """Expectation-maximisation over (votes, count): the prior, and P(vote | class) of each labeler.

    A labeler that abstains says nothing.  The start are the beliefs (without any: right in
    eight of ten cases), which fixes the meaning of the classes; they also weigh like a
    share ``anchor`` of the spans, so that labelers that vote for everything do not
    make one class of it.
    """
    width = len(patterns[0][0]) if patterns else 0
    believed = [[[1 - no, no], [1 - yes, yes]] for no, yes in beliefs or ((0.2, 0.8),) * width]
    prior, given = 0.5, believed
    total = sum(n for _, n in patterns)
    weight = 1 + (anchor * total if beliefs else 0)
    for _ in range(rounds if total else 0):
        sums, counts = 0.0, [[[weight * x for x in side] for side in labeler] for labeler in believed]
        for vote, n in patterns:
            p = posterior(vote, prior, given)
            sums += n * p
            for k, v in enumerate(vote):
                if v >= 0:
                    counts[k][0][v] += n * (1 - p)
                    counts[k][1][v] += n * p
        prior = min(0.99, max(0.01, (sums + weight) / (total + 2 * weight)))
        given = [[[x / sum(c) for x in c] for c in labeler] for labeler in counts]
    return prior, given


def posterior(vote: tuple[int, ...], prior: float, given: list[list[list[float]]]) -> float:
    odds = math.log(prior / (1 - prior))
    for v, labeler in zip(vote, given):
        if v >= 0:
            odds += math.log(labeler[1][v] / labeler[0][v])
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


# ---- classifier --------------------------------------------------------------------------


def _features() -> Column:
    """Buckets of what a span and its surroundings look like; the labelers' opinions on words are not among them."""
    match, before, after = F.col("match"), F.col("before"), F.col("after")
    shape = F.regexp_replace(F.regexp_replace(F.substring("match", 1, 64), "[0-9]", "9"), r"\p{L}+", "a")
    seen = {
        "pattern": F.col("pattern"),
        "rule": F.col("v_rule").cast("string"),
        "digits": F.least(F.char_length("digits"), F.lit(24)).cast("string"),
        "length": F.least(F.floor(F.char_length("match") / 4), F.lit(16)).cast("string"),
        "shape": shape,
        "begin": F.substring("digits", 1, 2),
        "ending": F.lower(F.regexp_extract(match, r"([A-Za-z]+)$", 1)),
        "word_before": F.lower(F.regexp_extract(before, r"(\p{L}+)[^\p{L}]*$", 1)),
        "word_earlier": F.lower(F.regexp_extract(before, r"(\p{L}+)[^\p{L}]+\p{L}+[^\p{L}]*$", 1)),
        "word_after": F.lower(F.regexp_extract(after, r"^[^\p{L}]*(\p{L}+)", 1)),
        "sign_before": F.regexp_replace(F.substring(before, -1, 1), r"\p{L}", "a"),
        "sign_after": F.regexp_replace(F.substring(after, 1, 1), r"\p{L}", "a"),
    }
    names = [F.concat_ws("|", "kind", F.lit(name), value) for name, value in seen.items()]
    return F.array(*[F.pmod(F.xxhash64(name), F.lit(BUCKETS)).cast("int") for name in names])


def classifier(voted: DataFrame) -> Column:
    """The probability that a span is personal data, as a column over ``votes``.

    A linear scorer over hashed features; their weights are log odds under the posterior
    labels, and a feature seen a few times only weighs next to nothing.
    """
    counted = voted.groupBy("kind", *LABELERS).count().collect()
    chance, score, totals = F.lit(0.0), F.lit(0.0), {}
    for kind in KINDS:
        seen = [(tuple(r[v] for v in LABELERS), r["count"]) for r in counted if r["kind"] == kind]
        fitted = reliabilities(seen, beliefs=BELIEFS)
        yes = no = 0.0
        for vote, n in seen:
            same, p = F.col("kind") == kind, posterior(vote, *fitted)
            yes, no = yes + n * p, no + n * (1 - p)
            for name, v in zip(LABELERS, vote):
                same &= F.col(name) == v
            chance = F.when(same, p).otherwise(chance)
        totals[kind] = yes, no
        score = F.when(F.col("kind") == kind, math.log((yes + 1) / (no + 1))).otherwise(score)
    weighted = voted.select("kind", F.explode(_features()).alias("bucket"), chance.alias("p"))
    sums = weighted.groupBy("kind", "bucket").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    if not sums:
        return F.lit(0.0)
    weights = {kind: [0.0] * BUCKETS for kind in KINDS}
    for r in sums:
        yes, no = totals[r["kind"]]
        usual = yes / (yes + no)
        if 0 < usual < 1:
            for_it = (r["yes"] + SMOOTHING * usual) / (yes + SMOOTHING)
            against = (r["no"] + SMOOTHING * (1 - usual)) / (no + SMOOTHING)
            weights[r["kind"]][r["bucket"]] = math.log(for_it / against)
    table = F.lit(None)
    for kind, listed in weights.items():
        values = F.expr("array(" + ",".join(f"{w!r}D" for w in listed) + ")")
        table = F.when(F.col("kind") == kind, values).otherwise(table)
    return 1 / (1 + F.exp(-F.aggregate(_features(), score, lambda sum_, bucket: sum_ + F.get(table, bucket))))


def scored(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows, and every match with ``strict`` and ``p``, the classifier's probability."""
    rows, found = candidates(docs)
    voted = staged(votes(found), "votes")
    return rows, voted.withColumn("p", classifier(voted))


def kept_spans(docs: DataFrame, accepted: float = ACCEPTED) -> tuple[DataFrame, DataFrame]:
    """All rows, and one row (row_id, strict, no, start, end, kind) per span that passes.

    An added span never overlaps one that stays.  Both sides of a span are seen by running
    extremes, so the work on a text grows with its spans and not with their square.
    """
    rows, found = scored(docs)
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    spans = found.where(F.col("strict") | (F.col("p") >= accepted)).select(
        "row_id", "strict", number.alias("no"),
        F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "kind",
    )
    from_left = Window.partitionBy("row_id").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    from_right = Window.partitionBy("row_id").orderBy(F.desc("start")).rowsBetween(Window.unboundedPreceding, 0)
    spans = spans.withColumn("reached", F.max(F.when(F.col("strict"), F.col("end"))).over(from_left))
    spans = spans.withColumn("next", F.min(F.when(F.col("strict"), F.col("start"))).over(from_right))
    touched = (F.col("reached") > F.col("start")) | (F.col("next") < F.col("end"))
    return rows, spans.where(F.col("strict") | ~F.coalesce(touched, F.lit(False))).drop("reached", "next")


def spans(docs: DataFrame, accepted: float = ACCEPTED) -> DataFrame:
    """(row_id, doc_id, text_hash, base, spans) for every row of (doc_id, text).

    ``base`` and ``spans`` are arrays of (kind, start, end), by kind and start.
    """
    rows, kept = kept_spans(docs, accepted)
    span = F.struct("no", "start", "end", "kind")
    grouped = kept.groupBy("row_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("strict"), span))).alias("base"),
        F.array_sort(F.collect_set(span)).alias("spans"),
    )
    none = F.array().cast("array<struct<no:int,start:bigint,end:bigint,kind:string>>")
    return rows.join(grouped, "row_id", "left").select(
        "row_id", "doc_id", "text_hash", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans")
    )


def span_text(listed: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(listed, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _cuts(kept: DataFrame) -> DataFrame:
    """(row_id, blocks): what to cut out of each text, by blocks of ``BLOCK`` code points.

    Spans that overlap are one cut, of the first one's kind.  ``blocks`` has (block, parts) by
    block, a part is (from, to, label) inside its block; the label stands where the cut begins.
    """
    ordered = Window.partitionBy("row_id").orderBy("start", "end", "kind")
    reached = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    kept = kept.withColumn("new", F.when(reached > F.col("start"), 0).otherwise(1))
    kept = kept.withColumn("cut", F.sum("new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    cuts = kept.groupBy("row_id", "cut").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", "end", "kind")).alias("kind")
    )
    blocks = F.sequence(F.floor(F.col("start") / BLOCK), F.floor((F.col("end") - 1) / BLOCK))
    parts = cuts.select("row_id", "start", "end", "kind", F.posexplode(blocks).alias("nth", "block"))
    begin = F.col("block") * BLOCK
    part = F.struct(
        F.greatest(F.col("start") - begin, F.lit(0)).cast("int").alias("from"),
        F.least(F.col("end") - begin, F.lit(BLOCK)).cast("int").alias("to"),
        F.when(F.col("nth") == 0, F.concat(F.lit("["), F.upper("kind"), F.lit("]"))).otherwise("").alias("label"),
    )
    per_block = parts.groupBy("row_id", "block").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return per_block.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("block", "parts"))).alias("blocks"))


def _cut_out(text: Column, blocks: Column) -> Column:
    """``text`` without its cuts.  Every block is walked once for each of its own cuts, never from the text's start."""
    none = F.array().cast("array<struct<from:int,to:int,label:string>>")

    def with_gap(here: Column, i: Column) -> Column:
        following = F.coalesce(F.get(blocks, i + 1)["block"], here["block"] + 1)
        return F.concat(F.array(here["parts"]), F.array_repeat(none, (following - here["block"] - 1).cast("int")))

    # One array of parts for every block up to the last that has any.
    leading = F.array_repeat(none, F.get(blocks, F.lit(0))["block"].cast("int"))
    parts_of_blocks = F.concat(leading, F.flatten(F.transform(blocks, with_gap)))

    def without(block: Column, parts: Column) -> Column:
        def piece(part: Column, i: Column) -> Column:
            begin = F.when(i > 0, F.get(parts, i - 1)["to"]).otherwise(0)
            return F.concat(F.substring(block, begin + 1, part["from"] - begin), part["label"])

        rest = F.substring(block, F.try_element_at(parts, F.lit(-1))["to"] + 1, F.lit(BLOCK))
        cut = F.concat(F.array_join(F.transform(parts, piece), ""), rest)
        return F.when(F.coalesce(F.size(parts), F.lit(0)) > 0, cut).otherwise(block)

    in_blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    return F.array_join(F.zip_with(in_blocks, parts_of_blocks, without), "")


@shielded("doc_id", "text", "n_chars")
def redacted(docs: DataFrame, accepted: float = ACCEPTED) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; ``n_chars`` follows if it is there."""
    rows, kept = kept_spans(docs, accepted)
    found = rows.join(_cuts(kept), "row_id")
    # Equal ids with equal texts have equal spans.
    found = found.select(F.coalesce("doc_id", F.lit(0)).alias("__id"), F.col("text_hash").alias("__hash"), "blocks")
    found = found.dropDuplicates(["__id", "__hash"])
    keyed = docs.withColumns({"__id": F.coalesce("doc_id", F.lit(0)), "__hash": F.xxhash64("text")})
    joined = keyed.join(found, ["__id", "__hash"], "left")
    clean = F.when(F.col("blocks").isNull(), F.col("text")).otherwise(_cut_out(F.col("text"), F.col("blocks")))
    columns = [clean.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    out = joined.select(*columns)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out

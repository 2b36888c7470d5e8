"""Personal data: generators propose spans, boosted trees judge them, calibrated thresholds select.

Base spans (email, ip, card, phone with their checks) are always kept. Two further generators propose freely:
spelled or spaced addresses, and groups of digits, each group as a phone number, a card and an ip address at
once. Gradient boosted trees on format and context features score the proposals.

There are no labels, so the trees learn from what the corpus itself settles. Positive is a proposal that lies on a
base span of its kind; the features leave out the marks that made it one (a leading plus, how `@` and dots are
written, which separators a card has). Negative is a proposal that cannot be of its kind: it touches a base span of
another kind only, fails the kind's own check (digits, Luhn, octets), hangs together with letters or follows a word
that announces some other number. All other proposals, among them every real one that the base patterns miss,
are not learned from, however frequent they are; they are what the trees judge. The threshold of a kind is
calibrated on a third of what is learned from.

Everything that touches the corpus is a DataFrame expression. The trees are fitted on all settled proposals and
compiled into CASE expressions: equal ones are counted, and where more than `rows` different ones are left, Spark
sums their gradients by node, feature and value, so that only these sums go to the driver.

Regular expressions are written so that Java matches them without recursion and in linear time: a first
replacement marks separators that cannot belong to a match, after that each pattern is a run of one class.
Places are counted in code points. Null texts count as empty, without spans. Repeated rows and null ids are
searched like others; other columns stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktide.llm.common import fresh_name, remove, shared_folder, store
from clicktide.llm.quality_rules import let

KINDS = ("email", "ip", "card", "phone")
#: Different settled proposals that the driver fits the trees on; more are summed by Spark.
ROWS = 4000
#: Gradients are summed as whole multiples of 1 / UNIT, whose sums do not depend on an order.
UNIT = 1 << 30
#: Digits of a score, and those that a pass of `at_ranks` settles.
SCORE_BITS, PASS_BITS = 40, 10
#: Private signs: a mark around matches, a filler for separators out of place, what replaces them in a text.
MARK, FILLER, STRANGE = "", "", ""
#: Segments whose lengths are summed in a first step.
STEP = 512

SPAN = "array<struct<kind:string,start:int,end:int,match:string>>"


# --- Finding matches and their places ---------------------------------------------------------------


def matches(text: Column, pattern: str) -> Column:
    """All matches of a pattern, leftmost and without overlap: an array of (start, end, match)."""
    marked = F.split(F.regexp_replace(text, f"({pattern})", f"{MARK}$1{MARK}"), MARK)

    def places(parts: Column) -> Column:
        return let(F.transform(parts, lambda p: F.length(p)), lambda lengths: summed(parts, lengths))

    def summed(parts: Column, lengths: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.shiftright(F.size(lengths) - 1, STEP.bit_length() - 1)),
            lambda b: F.aggregate(F.slice(lengths, b * STEP + 1, F.lit(STEP)), F.lit(0), lambda a, n: a + n),
        )
        return let(blocks, lambda sums: spans(parts, lengths, sums))

    def spans(parts: Column, lengths: Column, sums: Column) -> Column:
        def start(i: Column) -> Column:
            block = F.shiftright(i, STEP.bit_length() - 1)
            before = F.aggregate(F.slice(sums, F.lit(1), block), F.lit(0), lambda a, n: a + n)
            return before + F.aggregate(
                F.slice(lengths, block * STEP + 1, i - block * STEP), F.lit(0), lambda a, n: a + n
            )

        return F.transform(
            F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: i % 2 == 1),
            lambda i: let(
                start(i),
                lambda s: F.struct(s.alias("start"), (s + lengths[i]).alias("end"), parts[i].alias("match")),
            ),
        )

    return let(marked, places)


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def total(turned: Column) -> Column:
        def add(a: Column, i: Column) -> Column:
            digit = F.substr(turned, i, F.lit(1)).cast("int")
            return a + F.when(i % 2 == 1, digit).when(digit > 4, 2 * digit - 9).otherwise(2 * digit)

        return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) % 10 == 0

    return let(F.reverse(number), total)


def octets(match: Column) -> Column:
    """Whether every number between dots is at most 255."""
    return F.forall(
        F.split(match, "\\."),
        lambda p: let(
            F.regexp_replace(p, "^0+", ""),
            lambda q: F.when(q == "", F.lit(True)).when(F.length(q) > 3, F.lit(False)).otherwise(q.cast("int") <= 255),
        ),
    )


#: Separators out of place, and the run that is a match once they are marked.
STRAY_DOT = "(?<![A-Za-z0-9-])\\.|\\.(?![A-Za-z0-9-])"
LOCAL = f"[A-Za-z0-9._%+\\-{FILLER}]"
EMAIL = f"(?:(?<!{LOCAL})|\\G){LOCAL}++@[A-Za-z0-9-]++\\.[A-Za-z0-9.-]++"
IP = "(?:(?<![0-9])|\\G)[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++"
STRAY_SPACE = "(?<![0-9])[ -]|[ -](?![0-9])"
CARD = "[0-9][0-9 -]++"
PHONE = "\\+[0-9][ ().0-9-]+[0-9]"
#: What a text must hold for a search to be worth while.
SOME_IP = "[0-9]\\.[0-9]++\\.[0-9]++\\.[0-9]"
SOME_CARD = "[0-9](?:[ -]?[0-9]){12}"
SOME_PHONE = "\\+[0-9][ ().0-9-]"


def plain(text: Column) -> Column:
    """The text without the private signs, place by place."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{MARK}{FILLER}]", STRANGE)


def named(kind: str, found: Column) -> Column:
    return F.transform(
        found,
        lambda m: F.struct(
            F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["match"].alias("match")
        ),
    )


def base_spans(text: Column) -> Column:
    """The base spans of a plain text, by kind as listed, then by place."""
    none = F.array().cast(SPAN)
    email = matches(F.regexp_replace(text, STRAY_DOT, FILLER), EMAIL)
    ip = F.filter(matches(text, IP), lambda m: octets(m["match"]))
    card = F.filter(
        matches(F.regexp_replace(text, STRAY_SPACE, FILLER), CARD),
        lambda m: let(digits(m["match"]), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(F.lit(False))),
    )
    phone = F.filter(matches(text, PHONE), lambda m: F.length(digits(m["match"])).between(9, 15))
    return F.concat(
        F.when(F.contains(text, F.lit("@")), named("email", email)).otherwise(none),
        F.when(text.rlike(SOME_IP), named("ip", ip)).otherwise(none),
        F.when(text.rlike(SOME_CARD), named("card", card)).otherwise(none),
        F.when(text.rlike(SOME_PHONE), named("phone", phone)).otherwise(none),
    )


# --- Proposals and their features -------------------------------------------------------------------

#: What parts an address: a sign or a bracketed word, with blanks or not, or a spelled word between blanks.
AT, DOT = "(?i:@|\\(at\\)|\\[at\\]| at )", "(?i:\\.|\\(dot\\)|\\[dot\\]| dot )"
#: A plain dot has no blank beside it: the end of a sentence is no domain.
DOTTED = "(?:\\.| ?(?i:\\(dot\\)|\\[dot\\]) ?|(?i: dot ))"
SPELLED = f"[A-Za-z0-9._%+-]{{1,64}}+ ?{AT} ?[A-Za-z0-9-]{{1,63}}(?:{DOTTED}[A-Za-z0-9-]{{1,63}}){{1,4}}"
GROUPED = "[+(]{0,2}[0-9](?:[ ().\\-/]{0,2}[0-9]){6,24}"
SOME_GROUPED = "[0-9](?:[ ().\\-/]{0,2}[0-9]){6}"
#: Characters around a proposal that count as its context.
CONTEXT = 24
#: Words that announce a contact, a payment or an address, and words that announce a number.
TELLING = "(?i)(mail|phone|tel|call|fax|mobile|contact|card|visa|pay|host|addr|reach|write)"
PLAIN_NUMBERS = "(?i)(version|licen|token|isbn|page|chapter|order|item|no\\.|total|price|[0-9])"
FEATURES = (
    "kind", "n_digits", "n_chars", "n_groups", "n_dots", "n_hyphens", "n_spaces", "n_parens", "octets", "luhn",
    "longest", "glued", "telling", "numbers", "in_range", "last_label",
)
#: Digits of a card and of a phone number.
CARD_DIGITS, PHONE_DIGITS = (13, 19), (9, 15)


def proposals(text: Column) -> Column:
    """Proposed spans with their features; a group of digits is proposed as three kinds at once."""
    spelled = text.rlike(AT) & text.rlike(DOT)  # every match of SPELLED holds both
    none = F.array().cast(SPAN)
    groups = matches(text, GROUPED)
    raw = F.concat(
        F.when(spelled, named("email", matches(text, SPELLED))).otherwise(none),
        F.when(
            text.rlike(SOME_GROUPED),
            let(groups, lambda g: F.concat(named("ip", g), named("card", g), named("phone", g))),
        ).otherwise(none),
    )

    def count(match: Column, sign: str) -> Column:
        return F.length(match) - F.length(F.regexp_replace(match, sign, ""))

    def described(p: Column) -> Column:
        match, number = p["match"], digits(p["match"])
        before = F.substr(text, F.greatest(F.lit(1), p["start"] - CONTEXT + 1), F.least(F.lit(CONTEXT), p["start"]))
        after = F.substr(text, p["end"] + 1, F.lit(1))
        parts = F.split(match, "[^0-9]+")
        kind = F.array_position(F.array(*map(F.lit, KINDS)), p["kind"]).cast("int") - 1

        def only(kinds: str, value: Column) -> Column:
            """A feature that other kinds do not have: it is a mark of their base pattern, or says nothing."""
            return F.when(p["kind"].isin(*kinds.split()), value).otherwise(0)

        in_range = F.when(p["kind"] == "card", F.length(number).between(*CARD_DIGITS)).when(
            p["kind"] == "phone", F.length(number).between(*PHONE_DIGITS)
        )
        last = F.regexp_extract(match, "([A-Za-z0-9-]+)$", 1)
        made = {
            "kind": kind,
            "n_digits": only("ip card", F.length(number)),
            # How an address is spelled, how a card is grouped and the country of a phone number are such marks.
            "n_chars": only("ip", F.length(match)),
            "n_groups": only("ip", F.size(F.filter(parts, lambda x: x != ""))),
            "n_dots": only("ip phone", count(match, DOT)),
            "n_hyphens": only("ip phone", count(match, "-")),
            "n_spaces": only("ip", count(match, " ")),
            "n_parens": only("ip phone", count(match, "[()]")),
            "in_range": F.coalesce(in_range, F.lit(True)).cast("int"),
            "last_label": only("email", F.when(last.rlike("^[A-Za-z]+$"), F.length(last)).otherwise(0)),
            "octets": F.when(match.rlike("^[0-9]+(\\.[0-9]+){3}$"), octets(match).cast("int")).otherwise(0),
            "luhn": F.when(F.length(number).between(*CARD_DIGITS), luhn(number).cast("int")).otherwise(0),
            "longest": only("ip phone", F.coalesce(F.array_max(F.transform(parts, lambda x: F.length(x))), F.lit(0))),
            "glued": before.rlike("[A-Za-z0-9=\"_]$").cast("int") + after.rlike("^[A-Za-z0-9\"_]").cast("int"),
            "telling": before.rlike(TELLING).cast("int"),
            "numbers": before.rlike(PLAIN_NUMBERS).cast("int"),
        }
        return F.struct(
            p["kind"].alias("kind"),
            p["start"].alias("start"),
            p["end"].alias("end"),
            F.array(*[F.coalesce(made[name].cast("int"), F.lit(0)) for name in FEATURES]).alias("features"),
        )

    return F.transform(raw, described)


def impossible(kind: Column, features: Column) -> Column:
    """Whether a proposal cannot be of its kind, whatever it looks like."""

    def value(name: str) -> Column:
        return features[FEATURES.index(name)]

    failed = (
        F.when(kind == "card", (value("in_range") == 0) | (value("luhn") == 0))
        .when(kind == "ip", value("octets") == 0)
        .when(kind == "phone", (value("in_range") == 0) | (value("octets") == 1))
        .otherwise(value("last_label") < 2)
    )
    return failed | (value("glued") > 0) | (value("numbers") > 0)


def overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def annotate(documents: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """All rows and columns with a struct `into`: the base spans and the proposals, each with its weak label.

    `same` is true, false or, for a proposal that nothing settles, null; `taken` says that it touches a base span.
    """

    def both(t: Column) -> Column:
        def labelled(base: Column) -> Column:
            return F.struct(
                F.transform(base, lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end"))).alias("base"),
                F.transform(
                    proposals(t),
                    lambda p: let(
                        F.exists(base, lambda b: overlaps(p, b)),
                        lambda taken: F.struct(
                            p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end"),
                            p["features"].alias("features"),
                            F.when(taken, F.exists(base, lambda b: overlaps(p, b) & (b["kind"] == p["kind"])))
                            .when(impossible(p["kind"], p["features"]), F.lit(False)).alias("same"),
                            taken.alias("taken"),
                        ),
                    ),
                ).alias("proposed"),
            )

        return let(base_spans(t), labelled)

    return documents.withColumn(into, let(plain(F.col(text)), both))


# --- Gradient boosted trees -------------------------------------------------------------------------


@dataclass
class Trees:
    """An additive model of the log odds: leaves are numbers, inner nodes (feature, bound, low, high)."""

    start: float = 0.0
    trees: list = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)

    def margin(self, x: np.ndarray) -> np.ndarray:
        def walk(node, rows: np.ndarray) -> np.ndarray:
            if not isinstance(node, tuple):
                return np.full(len(rows), node)
            out, low = np.empty(len(rows)), rows[:, node[0]] <= node[1]
            out[low], out[~low] = walk(node[2], rows[low]), walk(node[3], rows[~low])
            return out

        return self.start + sum((walk(t, x) for t in self.trees), np.zeros(len(x)))

    def expression(self, features: Column) -> Column:
        """The same sum as nested CASE expressions."""

        def walk(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            return F.when(features[node[0]] <= node[1], walk(node[2])).otherwise(walk(node[3]))

        out = F.lit(float(self.start))
        for tree in self.trees:
            out = out + walk(tree)
        return out


def grow(x: np.ndarray, slope: np.ndarray, curve: np.ndarray, depth: int, rate: float):
    """A regression tree on gradients (Newton steps in the leaves)."""

    def gain(s: float, c: float) -> float:
        return s * s / (c + 1.0)

    total, best = (slope.sum(), curve.sum()), (1e-6, None, None)
    if depth:
        for f in range(x.shape[1]):
            order = np.argsort(x[:, f], kind="stable")
            value = x[order, f]
            left_s, left_c = np.cumsum(slope[order])[:-1], np.cumsum(curve[order])[:-1]
            ends = np.flatnonzero(value[1:] != value[:-1])
            for e in ends.tolist():
                if left_c[e] < 1.0 or total[1] - left_c[e] < 1.0:
                    continue
                won = gain(left_s[e], left_c[e]) + gain(total[0] - left_s[e], total[1] - left_c[e]) - gain(*total)
                if won > best[0]:
                    best = (won, f, int(value[e]))
    if best[1] is None:
        return rate * total[0] / (total[1] + 1.0)
    low = x[:, best[1]] <= best[2]
    return (
        best[1], best[2],
        grow(x[low], slope[low], curve[low], depth - 1, rate), grow(x[~low], slope[~low], curve[~low], depth - 1, rate),
    )


def boost(
    x: np.ndarray, y: np.ndarray, times: np.ndarray | None = None, rounds: int = 40, depth: int = 3, rate: float = 0.4,
    recall: float = 0.95, least: float = 0.9,
) -> Trees:
    """Trees on two thirds of the proposals; each kind's threshold keeps `recall` of the positives of the rest.

    `times` says how often a row of features occurred; only its proportions count, so a table and its copies
    give the same trees. A threshold is never below `least`; a kind with fewer than five positives to calibrate
    on selects nothing.
    """
    times = np.ones(len(y), np.int64) if times is None else np.asarray(times, np.int64)
    times = times // max(int(np.gcd.reduce(times)), 1)
    apart = np.where(times >= 3, times // 3, (np.arange(len(y)) % 3 == 2) * times)  # for the thresholds
    weight = (times - apart).astype(float)
    share = float(np.clip((y * weight).sum() / max(weight.sum(), 1.0), 1e-4, 1 - 1e-4))
    model = Trees(float(np.log(share / (1 - share))))
    margin = np.full(len(y), model.start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        model.trees.append(grow(x, (y - p) * weight, p * (1 - p) * weight, depth, rate))
        margin = model.margin(x)
    scores = 1 / (1 + np.exp(-margin))
    for k, kind in enumerate(KINDS):
        mine = (y == 1) & (x[:, 0] == k)
        if apart[mine].sum() >= 5:
            # A little lower, so that rounding keeps out no proposal that looks just like a positive one.
            model.thresholds[kind] = max(least, quantile(scores[mine], apart[mine], 1 - recall) - 1e-9)
    return model


def quantile(values: np.ndarray, times: np.ndarray, share: float) -> float:
    """np.quantile of the values, each repeated `times`, without writing the repetitions out."""
    order = np.argsort(values, kind="stable")
    ends, place = np.cumsum(times[order]), share * (times.sum() - 1)
    low, high = values[order][np.searchsorted(ends, [np.floor(place), np.ceil(place)], "right")]
    return float(low + (high - low) * (place - np.floor(place)))


def best_split(sums: dict[int, list[tuple[int, int, int]]], total: tuple[int, int]):
    """The split of `grow` from the sums (value, slope, curve) of each feature: (feature, bound, sums of the low side)."""

    def gain(s: int, c: int) -> float:
        return (s / UNIT) ** 2 / (c / UNIT + 1.0)

    best, found = 1e-6, None
    for f in sorted(sums):
        low_s = low_c = 0
        for value, s, c in sorted(sums[f])[:-1]:
            low_s, low_c = low_s + s, low_c + c
            high_s, high_c = total[0] - low_s, total[1] - low_c
            if low_c < UNIT or high_c < UNIT:
                continue
            won = gain(low_s, low_c) + gain(high_s, high_c) - gain(*total)
            if won > best:
                best, found = won, (f, value, (low_s, low_c))
    return found


def grow_all(rows: DataFrame, depth: int, rate: float):
    """The tree of `grow` on rows (features, label, weight, margin): a pass of Spark for each level.

    A level's sums by node, feature and value go to the driver; features are counts within short spans, so there
    are few values. Nodes are numbered like a heap.
    """
    splits: dict[int, tuple[int, int]] = {}
    totals: dict[int, tuple[int, int]] = {}

    def node(number: int = 1) -> Column:
        if number not in splits:
            return F.lit(number)
        f, bound = splits[number]
        return F.when(F.col("features")[f] <= bound, node(2 * number)).otherwise(node(2 * number + 1))

    p = 1 / (1 + F.exp(-F.col("margin")))

    def whole(gradient: Column) -> Column:
        return F.sum((F.round(gradient * UNIT).cast("long") * F.col("weight")).cast("decimal(38,0)"))

    level = [1]
    for _ in range(depth):
        each = rows.select(
            node().alias("node"), (F.col("label") - p).alias("slope"), (p * (1 - p)).alias("curve"), "weight",
            F.posexplode("features").alias("feature", "value"),
        ).where(F.col("node").isin(level))
        summed = each.groupBy("node", "feature", "value").agg(whole(F.col("slope")).alias("s"), whole(F.col("curve")).alias("c"))
        sums: dict[int, dict[int, list[tuple[int, int, int]]]] = {n: {} for n in level}
        for r in summed.collect():
            sums[r.node].setdefault(r.feature, []).append((r.value, int(r.s), int(r.c)))
        for n in level:
            if n == 1:
                totals[1] = (sum(s for _, s, _ in sums[1][0]), sum(c for _, _, c in sums[1][0]))
            if found := best_split(sums[n], totals[n]):
                f, bound, low = found
                splits[n] = f, bound
                totals[2 * n], totals[2 * n + 1] = low, (totals[n][0] - low[0], totals[n][1] - low[1])
        level = [child for n in level if n in splits for child in (2 * n, 2 * n + 1)]
        if not level:
            break

    def built(number: int):
        if number in splits:
            return *splits[number], built(2 * number), built(2 * number + 1)
        s, c = totals[number]
        return rate * (s / UNIT) / (c / UNIT + 1.0)

    return built(1)


def at_ranks(keys: DataFrame, wanted: list[tuple[int, int]]) -> list[int]:
    """The key at each (kind, rank from 0) of rows (kind, key, times): its leading bits by counts, some in each pass."""
    heads = [(kind, 0, rank) for kind, rank in wanted]
    for shift in range(SCORE_BITS - PASS_BITS, -1, -PASS_BITS):
        head, met = F.shiftright("key", shift), F.lit(False)
        for kind, above, _ in heads:
            met = met | ((F.col("kind") == kind) & (F.shiftright("key", shift + PASS_BITS) == above))
        counts = sorted(map(tuple, keys.where(met).groupBy("kind", head.alias("head")).agg(F.sum("times")).collect()))
        found = []
        for kind, above, rank in heads:
            for own, value, n in counts:
                if own == kind and value >> PASS_BITS == above:
                    if rank < n:
                        found.append((kind, value, rank))
                        break
                    rank -= n
        heads = found
    return [value for _, value, _ in heads]


def boost_all(
    counted: DataFrame, rounds: int = 40, depth: int = 3, rate: float = 0.4, recall: float = 0.95, least: float = 0.9,
) -> Trees:
    """`boost` on any number of stored rows (features, label, n), none of which goes to the driver.

    Of rows that occur fewer than three times, those with a hash in one third of all are set apart. The rounds
    end when no split is left.
    """
    spark = counted.sparkSession
    unit = counted.agg(F.min("n")).first()[0]
    while rest := counted.where(F.col("n") % unit > 0).agg(F.min(F.col("n") % unit)).first()[0]:
        unit = rest  # Euclid's algorithm
    third = F.pmod(F.xxhash64("label", "features"), F.lit(3)) == 2
    rows = counted.select("features", "label", F.expr(f"n div {unit}").alias("times"))
    apart = F.when(F.col("times") >= 3, F.expr("times div 3")).when(third, F.col("times")).otherwise(F.lit(0).cast("long"))
    rows = rows.withColumn("apart", apart).withColumn("weight", F.col("times") - F.col("apart"))
    total = rows.agg(F.sum(F.col("label") * F.col("weight")), F.sum("weight")).first()
    share = float(np.clip(total[0] / max(total[1], 1), 1e-4, 1 - 1e-4))
    model, folder = Trees(float(np.log(share / (1 - share)))), None
    margin = F.lit(model.start)
    for _ in range(rounds):
        last, folder = folder, shared_folder(spark)
        rows = store(rows.select("features", "label", "apart", "weight", margin.alias("margin")), folder)
        if last:
            remove(spark, last)
        tree = grow_all(rows, depth, rate)
        model.trees.append(tree)
        margin = F.col("margin") + Trees(trees=[tree]).expression(F.col("features"))
        if not isinstance(tree, tuple):
            break
    score = 1 / (1 + F.exp(-margin))
    key = F.least(F.floor(score * (1 << SCORE_BITS)), F.lit((1 << SCORE_BITS) - 1)).cast("long")
    keys = rows.where("label = 1 AND apart > 0").select(F.col("features")[0].alias("kind"), key.alias("key"), F.col("apart").alias("times"))
    places = {
        r.kind: (1 - recall) * (r.n - 1) for r in keys.groupBy("kind").agg(F.sum("times").alias("n")).collect() if r.n >= 5
    }
    wanted = [(k, int(end)) for k, place in places.items() for end in (np.floor(place), np.ceil(place))]
    found = iter(at_ranks(keys, wanted))
    for k, place in places.items():
        low, high = next(found) / (1 << SCORE_BITS), next(found) / (1 << SCORE_BITS)
        model.thresholds[KINDS[k]] = max(least, low + (high - low) * (place - np.floor(place)) - 1e-9)
    if folder:
        remove(spark, folder)
    return model


def fit(annotated: DataFrame, into: str = "pii", rows: int = ROWS) -> Trees:
    """Trees fitted on all settled proposals, each counting as often as it occurs.

    Up to `rows` different ones are fitted on the driver; more stay where they are and Spark sums their gradients.
    """
    settled = F.filter(F.col(into)["proposed"], lambda p: p["same"].isNotNull())
    each = annotated.select(F.explode(settled).alias("p")).select(
        F.col("p.features").alias("features"), F.col("p.same").cast("int").alias("label")
    )
    counted = each.groupBy("features", "label").agg(F.count("*").alias("n"))
    chance = (F.pmod(F.xxhash64("features", "label"), F.lit(1 << 52)) + 1) / F.lit(float(1 << 52))
    ordered = counted.orderBy(F.desc(F.col("n") / chance), "features", "label")
    few = ordered.limit(rows + 1).collect()  # in an order that says which rows `boost` sets apart
    if not few:
        return Trees()
    if len(few) > rows:
        folder = shared_folder(annotated.sparkSession)
        model = boost_all(store(counted, folder))
        remove(annotated.sparkSession, folder)
        return model
    x, y = np.array([r.features for r in few], np.int64), np.array([r.label for r in few], float)
    return boost(x, y, np.array([r.n for r in few], np.int64))


def selected(model: Trees, pii: Column) -> Column:
    """All spans: the base ones and the proposals above their kind's threshold that touch none of them.

    Of proposals that overlap, the one with the higher score stays, then the earlier, then the longer one.
    """
    base = F.transform(pii["base"], lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end")))
    if not model.thresholds:
        return ordered(base)
    scored = F.transform(
        F.filter(pii["proposed"], lambda p: ~p["taken"]),
        lambda p: F.struct((-model.expression(p["features"])).alias("worst"), p["start"].alias("start"),
                           (-p["end"]).alias("back"), p["kind"].alias("kind")),
    )
    bound = F.lit(float("inf"))
    odds = {k: float(np.log(t / (1 - t))) if t < 1 else float("inf") for k, t in model.thresholds.items()}

    def passes(p: Column) -> Column:
        limit = bound
        for kind, least in odds.items():
            limit = F.when(p["kind"] == kind, F.lit(least)).otherwise(limit)
        return -p["worst"] >= limit

    def add(kept: Column, p: Column) -> Column:
        span = F.struct(p["kind"].alias("kind"), p["start"].alias("start"), (-p["back"]).alias("end"))
        return F.when(F.exists(kept, lambda k: overlaps(k, span)), kept).otherwise(F.concat(kept, F.array(span)))

    more = F.aggregate(
        F.array_sort(F.filter(scored, passes)), F.array().cast("array<struct<kind:string,start:int,end:int>>"), add
    )
    return ordered(F.concat(base, more))


def ordered(spans: Column) -> Column:
    """By kind as listed, then by start."""
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("place"),
            s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
        ),
    )
    return F.transform(
        F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )


def written(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def find(documents: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """All rows and columns but the text, with `base` and all `spans` as arrays of (kind, start, end).

    The proposals are stored once; the trees are fitted on them and applied to them.
    """
    held = fresh_name(documents, "pii")
    kept = [c for c in documents.columns if c not in (text, "base", into)]
    stored = store(annotate(documents, text, held).select(*[F.col(f"`{c}`") for c in kept], held))
    model = fit(stored, held)
    return stored.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col(held)["base"].alias("base"),
        selected(model, F.col(held)).alias(into),
    )


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """A row per document: the base counts and their digest, and all spans."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select(
        doc_id, *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )


def redact(documents: DataFrame, text: str = "text") -> DataFrame:
    """All rows in the columns they came with; every span of personal data is replaced by `[KIND]`."""
    held, every = fresh_name(documents, "pii"), fresh_name(documents, "all")
    stored = store(annotate(documents, text, held))
    model = fit(stored, held)

    def merged(spans: Column) -> Column:
        by_place = F.array_sort(
            F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
        )
        return F.aggregate(
            by_place,
            F.array().cast("array<struct<start:int,end:int,kind:string>>"),
            lambda acc, s: F.when(
                (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] > s["start"]),
                F.concat(
                    F.slice(acc, F.lit(1), F.size(acc) - 1),
                    F.array(
                        F.struct(
                            F.element_at(acc, -1)["start"].alias("start"),
                            F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"),
                            F.element_at(acc, -1)["kind"].alias("kind"),
                        )
                    ),
                ),
            ).otherwise(F.concat(acc, F.array(s))),
        )

    def replaced(spans: Column) -> Column:
        whole = F.col(f"`{text}`")
        pieces = F.transform(
            spans,
            lambda s, i: let(
                F.when(i > 0, spans[i - 1]["end"]).otherwise(0),
                lambda last: F.concat(
                    F.substr(whole, last + 1, s["start"] - last), F.lit("["), F.upper(s["kind"]), F.lit("]")
                ),
            ),
        )
        rest = F.substr(whole, F.element_at(spans, -1)["end"] + 1)
        return F.concat(F.array_join(pieces, ""), rest)

    clean = F.when(F.size(F.col(every)) == 0, F.col(f"`{text}`")).otherwise(let(merged(F.col(every)), replaced))
    marked = stored.withColumn(every, selected(model, F.col(held)))
    return marked.withColumn(text, F.when(F.col(f"`{text}`").isNotNull(), clean)).select(
        *[F.col(f"`{c}`") for c in documents.columns]
    )

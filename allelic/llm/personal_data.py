"""Personal data by weak supervision, in DataFrame operations only.

Candidates are the matches of the base patterns and of wider ones (numbers in
local notation, national identifiers, spelled-out addresses, bank account
numbers whose check digits hold, access keys of known forms).  Labelers vote
on each candidate: its own form (regex), word lists about it (gazetteers of
cues, of counter-cues and of domain ends) and what stands around it (context).
Expectation-maximisation over the counts of vote patterns estimates each
labeler's reliability and each pattern's probability of being personal data;
a logistic span classifier is then trained on these probabilities, weighted by
counts, and decides on the wider candidates.  Base matches that pass their
checks always stay.

The counts cover all documents.  Votes and features are small discrete values,
so at most a few thousand combinations exist whatever the input; only they
reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelic.llm.common import stored, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: Base patterns.  They match what the plain forms in the comments match;
#: possessive repeats and the look-behind only keep long runs linear.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Wider patterns, in order of preference at one place.
WIDE = {
    "spelled": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:[\[(]dot[\])]|\.)\x20?[A-Za-z0-9-]++)++",
    "local": r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
    "national": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9_])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,72}|sk_live_[A-Za-z0-9]{16,64})(?![A-Za-z0-9_-])",
}
#: Length of an account number (ISO 13616) by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24,
    "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19,
    "SK": 24, "SM": 27, "TR": 26,
}
#: What a kept wide candidate is called.
NAMES = {"spelled": "email", "local": "phone", "national": "national"}
CONTEXT = 40
CUES = r"\b(?:call|phone|tel|mobile|fax|contact|e-?mail|mail|write|reach|card|visa|pay|address|ssn|social security|host|server|login|ip|iban|account|bank|transfer|key|token|secret|credentials?)\b"
COUNTER_CUES = r"\b(?:order|invoice|version|isbn|issn|serial|part|page|section|chapter|figure|table|ticket|ref)\b"
ENDS = r"(?i)\.(?:com|org|net|edu|gov|info|io|eu|uk|de|fr|es|it)$"
LABELERS = ("form", "cue", "counter", "list", "edge")
ROUNDS, STEPS, RATE, RIDGE = 50, 400, 0.5, 1e-3


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, not at each use in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def prefix_sums(lengths: Column, block: int = 256) -> Column:
    """Sum of the elements before each element; by blocks, so that very many
    matches in a text cost far less than their square."""
    def total(a):
        return F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)

    def with_blocks(own):
        last = F.floor((F.size(own) - 1) / block).cast("int")
        sums = F.transform(F.sequence(F.lit(0), last), lambda b: total(F.slice(own, b * block + 1, block)))
        return _let(sums, lambda blocks: _let(
            F.transform(blocks, lambda _, b: total(F.slice(blocks, F.lit(1), b))),
            lambda before: F.transform(own, lambda _, i: F.element_at(before, (F.floor(i / block) + 1).cast("int"))
                                       + total(F.slice(own, (F.floor(i / block) * block + 1).cast("int"), i % block)))))

    return _let(lengths, with_blocks)


def _matches(docs: DataFrame, patterns: dict[str, str], can_match: dict[str, Column]) -> DataFrame:
    """Adds a column for each pattern: (m, before, after, start, end) of all
    matches, the texts between matches cut to the context.  The text outside
    the matches comes from splitting by the same pattern, so a text is scanned
    twice at most for a pattern and no part of it is copied per match."""
    docs = docs.withColumns({f"_m_{k}": F.when(can_match[k], F.regexp_extract_all("_text", F.lit(p), F.lit(0))) for k, p in patterns.items()})
    docs = docs.withColumns({f"_p_{k}": F.when(F.size(f"_m_{k}") > 0, F.split("_text", p, -1)) for k, p in patterns.items()})

    def spans(k: str) -> Column:
        m, p, n = F.col(f"_m_{k}"), F.col(f"_p_{k}"), F.size(f"_m_{k}")
        lengths = F.zip_with(F.slice(p, F.lit(1), n), m, lambda x, y: (F.length(x) + F.length(y)).cast("long"))
        zipped = F.arrays_zip(m.alias("m"), F.slice(p, F.lit(1), n).alias("p"), F.slice(p, F.lit(2), n).alias("q"),
                              prefix_sums(lengths).alias("s"))
        return F.when(n > 0, F.transform(zipped, lambda x: F.struct(
            x["m"].alias("m"), F.right(x["p"], F.lit(CONTEXT)).alias("before"), F.left(x["q"], F.lit(CONTEXT)).alias("after"),
            (x["s"] + F.length(x["p"])).alias("start"), (x["s"] + F.length(x["p"]) + F.length(x["m"])).alias("end"))))

    return docs.withColumns({f"_{k}": spans(k) for k in patterns})


def _luhn(digits: Column) -> Column:
    """Whether a string of up to 19 digits passes the Luhn check."""
    def add(total, i):
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 0, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _compact(m: Column) -> Column:
    return F.regexp_replace(m, " ", "")


def _mod_97(m: Column) -> Column:
    """Remainder of an account number: country and check digits last, letters as 10 to 35."""
    def add(rest, c):
        letter = c >= "A"
        return (rest * F.when(letter, 100).otherwise(10) + F.when(letter, F.ascii(c) - 55).otherwise(F.ascii(c) - 48)) % 97
    return _let(_compact(m), lambda x: F.aggregate(
        F.filter(F.split(F.concat(F.substr(x, F.lit(5)), F.left(x, F.lit(4))), ""), lambda c: c != ""), F.lit(0), add))


def passes(kind: str, m: Column) -> Column:
    """The checks of a match; those of the base patterns are the base's own."""
    if kind == "iban":
        return _mod_97(m) == 1
    if kind == "ip":
        def part(p):
            number = F.regexp_replace(p, "^0+", "")
            return (F.length(number) < 3) | ((F.length(number) == 3) & (number <= "255"))
        return F.forall(F.split(m, r"\."), part)
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _votes(kind: str, x: Column) -> list[Column]:
    """The labelers' votes: 1 personal, 0 not, -1 none."""
    around = F.lower(F.concat_ws(" ", x["before"], x["after"]))
    digits = F.regexp_replace(x["m"], "[^0-9]", "")
    if kind in PATTERNS:
        form = passes(kind, x["m"])
    elif kind == "national":
        form = ~x["m"].rlike(r"^(?:000|666|9)|-00-|0000$")
    elif kind == "local":
        form = ~x["m"].rlike(r"^\(?[01]") & (x["m"].rlike(r"^\(\d{3}\)") | x["m"].rlike(r"^\d{3}([ .-])\d{3}\1"))
    elif kind == "iban":
        known = F.create_map(*[F.lit(v) for pair in IBAN_LENGTHS.items() for v in pair])
        form = _let(_compact(x["m"]), lambda c: F.coalesce(F.try_element_at(known, F.left(c, F.lit(2))) == F.length(c), F.lit(False)))
    elif kind == "secret":
        form = x["m"].rlike("[0-9]") & x["m"].rlike("[A-Za-z]{2}")
    else:
        form = x["m"].rlike(r"[\[(]dot[\])]|\.")
    listed = (F.when(x["m"].rlike(ENDS) | x["m"].rlike(r"(?i)\b(?:com|org|net|edu)$"), 1).otherwise(-1) if kind in ("email", "spelled")
              else F.when(digits.rlike(r"^(\d)\1*$|^0*1234567"), 0).otherwise(-1))
    edge = ~(x["before"].rlike(r"[A-Za-z0-9]$") | x["after"].rlike(r"^[A-Za-z0-9]"))
    votes = (form.cast("int"), F.when(around.rlike(CUES), 1).otherwise(-1),
             F.when(x["before"].rlike("(?i)" + COUNTER_CUES), 0).otherwise(-1), listed, edge.cast("int"))
    return [v.cast("int").alias(name) for v, name in zip(votes, LABELERS, strict=True)]


def _judged(kind: str, spans: str, base: bool) -> Column:
    """Candidates with their votes and features; an account number must pass its check to be one."""
    held = F.filter(spans, lambda x: passes(kind, x["m"])) if kind == "iban" else F.col(spans)
    return F.coalesce(F.transform(held, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), F.lit(kind).alias("kind"),
        (passes(kind, x["m"]) if base else F.lit(False)).alias("sure"), *_votes(kind, x),
        F.least(F.floor(F.length(x["m"]) / 6), F.lit(5)).cast("int").alias("size"),
        x["before"].rlike(r"(?:^|[\s:;,(])$").cast("int").alias("opened"))), F.array())


def candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, found): the candidates of every row, base and wide."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("_text"))
    rows = rows.withColumn("_digit", F.col("_text").rlike("[0-9][^@]?[0-9]"))
    can = {"email": F.contains("_text", F.lit("@")), "ip": F.col("_digit"), "card": F.col("_digit"),
           "phone": F.contains("_text", F.lit("+")) & F.col("_text").rlike(r"\+[0-9]"),
           "spelled": F.col("_text").rlike(r"[\[(]at[\])]"), "local": F.col("_digit"), "national": F.col("_digit"),
           "iban": F.col("_digit") & F.col("_text").rlike("[A-Z]{2}[0-9]{2}"),
           "secret": F.col("_text").rlike("AKIA|gh[pousr]_|xox[abprs]-|sk_live_")}
    rows = _matches(rows, {**PATTERNS, **WIDE}, can)
    return rows.select("id", F.concat(*[_judged(k, f"_{k}", k in PATTERNS) for k in (*PATTERNS, *WIDE)]).alias("found"))


def reliabilities(patterns: list[tuple[str, tuple[int, ...], int]]) -> dict[tuple[str, tuple[int, ...]], float]:
    """Probability of each (kind, votes), given (kind, votes, count), by EM.

    One labeler's votes are independent given the truth; each kind has a share
    of personal data of its own.  It starts from the mean of the cast votes.
    """
    start = {}
    for kind, votes, _ in patterns:
        cast = [v for v in votes if v >= 0]
        start[kind, votes] = (sum(cast) + 0.5) / (len(cast) + 1)
    q = start
    for _ in range(ROUNDS):
        right = [[[1.0, 2.0], [2.0, 1.0]] for _ in LABELERS]  # votes 0 and 1, of false and true candidates
        shares: dict[str, list[float]] = {}
        for kind, votes, n in patterns:
            p = q[kind, votes]
            share = shares.setdefault(kind, [1.0, 1.0])
            share[0] += n * (1 - p)
            share[1] += n * p
            for labeler, v in zip(right, votes, strict=True):
                if v >= 0:
                    labeler[0][1 - v] += n * (1 - p)
                    labeler[1][v] += n * p
        new = {}
        for kind, votes, _ in patterns:
            yes, no = math.log(shares[kind][1]), math.log(shares[kind][0])
            for labeler, v in zip(right, votes, strict=True):
                if v >= 0:
                    no += math.log(labeler[0][1 - v] / sum(labeler[0]))
                    yes += math.log(labeler[1][v] / sum(labeler[1]))
            new[kind, votes] = 1 / (1 + math.exp(max(min(no - yes, 700), -700)))
        q = new
    return q


FEATURES = [*(f"kind {k}" for k in (*PATTERNS, *WIDE)), *(f"{x} {v}" for x in LABELERS for v in (0, 1)), *(f"size {s}" for s in range(6)), "opened"]


def _named(kind: str, votes: tuple[int, ...], size: int, opened: int) -> list[str]:
    return [f"kind {kind}", *(f"{x} {v}" for x, v in zip(LABELERS, votes, strict=True) if v >= 0),
            f"size {size}", *(["opened"] if opened else [])]


def train(found: DataFrame) -> dict[str, float]:
    """Weights of the span classifier, by feature, and its bias."""
    rows = sorted(tuple(r) for r in found.select(F.explode("found").alias("x")).select("x.*")
                  .groupBy("kind", *LABELERS, "size", "opened").count().collect())
    combos = [(r[0], tuple(r[1:1 + len(LABELERS)]), r[-3], r[-2], r[-1]) for r in rows]
    merged: dict[tuple, int] = {}
    for kind, votes, _, _, n in combos:
        merged[kind, votes] = merged.get((kind, votes), 0) + n
    q = reliabilities([(k, v, n) for (k, v), n in sorted(merged.items())])
    weights = dict.fromkeys([*FEATURES, "bias"], 0.0)
    total = sum(c[-1] for c in combos) or 1
    seen = dict.fromkeys(weights, 1e-9)
    for _ in range(STEPS):
        slope = {k: RIDGE * w for k, w in weights.items()}
        for kind, votes, size, opened, n in combos:
            names = ["bias", *_named(kind, votes, size, opened)]
            p = 1 / (1 + math.exp(-max(min(sum(weights[k] for k in names), 35), -35)))
            for k in names:
                slope[k] += n / total * (p - q[kind, votes])
        for k, g in slope.items():
            seen[k] += g * g
            weights[k] -= RATE * g / math.sqrt(seen[k])
    return weights


def _probability(x: Column, weights: dict[str, float]) -> Column:
    z = F.lit(weights["bias"])
    for k in (*PATTERNS, *WIDE):
        z = z + F.when(x["kind"] == k, weights[f"kind {k}"]).otherwise(0.0)
    for name in LABELERS:
        z = z + F.when(x[name] == 1, weights[f"{name} 1"]).when(x[name] == 0, weights[f"{name} 0"]).otherwise(0.0)
    for s in range(6):
        z = z + F.when(x["size"] == s, weights[f"size {s}"]).otherwise(0.0)
    return 1 / (1 + F.exp(-(z + F.when(x["opened"] == 1, weights["opened"]).otherwise(0.0))))


def _joined(spans: Column) -> Column:
    """kind:start:end, comma-joined, of (start, rank, end, kind)."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


#: Base spans of a text that are compared with an added one together.
BLOCK = 256


def _blocks(spans: Column) -> Column:
    """Spans sorted by start in blocks (lo, hi, own): nothing in a block begins before lo or ends after hi."""
    def block(b):
        return _let(F.slice(spans, b * BLOCK + 1, BLOCK), lambda own: F.struct(
            F.element_at(own, 1)["start"].alias("lo"), F.array_max(F.transform(own, lambda s: s["end"])).alias("hi"), own.alias("own")))
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / BLOCK).cast("int")), block)


def _meets(x: Column, s: Column, start: str = "start", end: str = "end") -> Column:
    return (s[start] < x["end"]) & (x["start"] < s[end])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone (base
    matches), base_sha256, spans (base and added ones).

    Null texts count as empty: no spans, and the digest of the empty string.
    Added spans that overlap a base span, or an added one that begins before,
    are left out.  Ids pass through, null or repeated.
    """
    found = stored(candidates(docs, id_col, text_col), "candidates")
    weights = train(found)
    rank = {k: i for i, k in enumerate((*KINDS, *WIDE))}

    def placed(x, name, order):
        return F.struct(x["start"].alias("start"), order.cast("int").alias("rank"), x["end"].alias("end"), name.alias("kind"))

    def order_of(x):
        return F.element_at(F.create_map(*[F.lit(v) for k, i in rank.items() for v in (k, i)]), x["kind"])

    names = F.create_map(*[F.lit(v) for k in rank for v in (k, NAMES.get(k, k))])
    sure = F.array_sort(F.transform(F.filter("found", lambda x: x["sure"]), lambda x: placed(x, x["kind"], order_of(x))))
    wide = F.filter("found", lambda x: x["kind"].isin(*WIDE) & (_probability(x, weights) >= 0.5))
    rows = found.select("id", sure.alias("sure"), F.array_sort(F.transform(
        wide, lambda x: placed(x, F.element_at(names, x["kind"]), order_of(x)))).alias("wide"))
    both = (F.size("wide") > 0) & (F.size("sure") > 0)
    rows = rows.withColumn("blocks", F.when(both, _blocks(F.col("sure"))))
    free = F.filter("wide", lambda x: ~F.exists("blocks", lambda b: _meets(x, b, "lo", "hi") & F.exists(b["own"], lambda s: _meets(x, s))))
    rows = rows.withColumn("free", F.when(both, free).otherwise(F.col("wide")))
    alone = F.filter("free", lambda x, i: (i == 0) | (F.element_at(F.col("free"), F.greatest(i, F.lit(1)))["end"] <= x["start"]))
    rows = rows.withColumn("added", F.when(F.size("free") > 1, alone).otherwise(F.col("free")))
    count = lambda k: F.size(F.filter("sure", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return rows.select(F.col("id").alias("doc_id"), *[count(k) for k in KINDS],
                       F.sha2(_joined(F.col("sure")), 256).alias("base_sha256"),
                       _joined(F.when(F.size("added") > 0, F.array_sort(F.concat("sure", "added"))).otherwise(F.col("sure"))).alias("spans"))

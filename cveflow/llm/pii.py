"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Kinds ``email``, ``ip``, ``card`` and ``phone`` are found by their pattern and validator alone.  The
weaker patterns - ``iban`` and ``local`` (a phone number without country code) - start below
``THRESHOLD`` and need a passed mod-97 check or a telling word in the ``CONTEXT`` characters before
them.  Where letters or digits follow an IBAN behind a space, the part of its country's length is taken if that
passes, else the longest that does.  Spans count
code points, ends are exclusive; those of one kind don't overlap.

The patterns can't be slow or overflow the stack on long runs: possessive loops, and a run of
characters is entered at its start or behind the last match only.

The time of a text grows with its length, however many matches it has: offsets and the words before a match are carried along, and
matches are gathered in chunks.

Nulls: a null text has no spans and stays null when redacted.  Repeated rows are searched each.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CONTEXT = 40
THRESHOLD = 0.5
#: Matches of a text that are placed together, and characters of a block that a text is cut from.
CHUNK = 256
BLOCK = 256


def _entered(run: str) -> str:
    return rf"(?:(?<!{run})|\G)"


#: Kinds in the order of results; a pattern; what a text must match to be searched at all.
PATTERNS = {
    "email": (_entered("[A-Za-z0-9._%+-]") + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (_entered("[0-9]") + r"[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]"),
    # whole runs of at least 13 digits; shorter ones can't pass
    "card": (r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,}+", "[0-9]"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
    # the first four characters; the words that an IBAN may span are looked at only, as another may start in them
    "iban": (r"\b(?=[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2})(?=([A-Z0-9]{4,34}+\b(?:\x20[A-Z0-9]{1,30}+\b){0,8}+))[A-Z]{2}[0-9]{2}",
             "[A-Z]{2}[0-9]{2}"),
    "local": (r"(?<![0-9+.-])\(?[0-9]{3,4}\)?[\x20-][0-9]{3,4}[\x20-][0-9]{3,4}(?![0-9]|[.-][0-9])", "[0-9]{3}"),
}
IBAN = r"^[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?$"
#: Fixed value: countries by the length of their IBANs; those of other countries or lengths are found too.
COUNTRIES = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
BASE = ("email", "ip", "card", "phone")
#: Score of a span whose validator passed, and words before it that raise the score by RAISE.
SCORES = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.9, "local": 0.3}
RAISE = 0.3
WORDS = {
    "email": "(?i)mail|contact", "ip": r"(?i)\bip\b|address|host", "card": "(?i)card|visa|credit",
    "phone": "(?i)phone|tel|call|mobile", "iban": "(?i)iban|account|bank", "local": "(?i)phone|tel|call|mobile|fax",
}


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    def add(total, i):
        digit = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        double = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, digit).otherwise(double)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN passes its check: country and check digits last, letters as 10 to 35, modulo 97 is 1."""
    compact = F.replace(iban, F.lit(" "))
    moved = F.split(F.concat(F.substring(compact, F.lit(5), F.length(compact)), F.substring(compact, 1, 4)), "")

    def add(rest, char):
        code = F.ascii(char)
        return F.when(code < 65, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.aggregate(F.filter(moved, lambda c: c != ""), F.lit(0), add) == 1


def first_iban(run: Column) -> Column:
    """The IBAN that some first words of a run are, or null: one of its country's length, else the longest."""
    parts = F.split(run, " ")
    starts = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), " "))
    found = F.filter(starts, lambda iban: iban.rlike(IBAN) & valid("iban", iban))
    return F.coalesce(F.get(F.filter(found, usual_length), F.lit(0)), F.get(found, F.lit(0)))


def usual_length(iban: Column) -> Column:
    """Whether an IBAN is as long as its country's are."""
    size, country = F.length(F.replace(iban, F.lit(" "))), F.substring(iban, 1, 2)
    return F.coalesce(*[F.when(country.isin(names.split()), size == n) for n, names in COUNTRIES.items()], F.lit(False))


def valid(kind: str, match: Column) -> Column:
    """The validator of a kind."""
    digits = F.length(_digits(match))
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (p.cast("bigint") <= 255))
    if kind == "card":
        return F.when(digits.between(13, 19), luhn(_digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return digits.between(9, 15)
    if kind == "iban":
        return F.when(F.length(F.replace(match, F.lit(" "))).between(15, 34), mod97(match)).otherwise(F.lit(False))
    return F.lit(True)


SPAN = "struct<kind:string,start:int,end:int,score:double>"


def _matches(text: Column, kind: str) -> Column:
    """Proposed matches and the stretches between them, or nulls if there is nothing to search."""
    pattern, needs = PATTERNS[kind]
    return F.when(text.rlike(needs), F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(int(kind == "iban"))).alias("found"), F.split(text, pattern, -1).alias("between")))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scan(items: Column, state: Column, out: str, step) -> Column:
    """What ``step(state, item)``, a new state and an array to put out, gives for one item after the other.

    Arrays grow by appending, which copies them; so the items of a chunk fill an array of their own.
    """
    empty = F.expr(f"cast(array() as array<{out}>)")

    def inner(acc, x):
        return _let(F.struct(*[c.alias(n) for c, n in zip(step(acc["state"], x), ("state", "out"))]), lambda r: F.struct(
            r["state"].alias("state"), F.concat(acc["out"], r["out"]).alias("out")))

    def outer(acc, chunk):
        done = F.aggregate(chunk, F.struct(acc["state"].alias("state"), empty.alias("out")), inner)
        return _let(done, lambda r: F.struct(r["state"].alias("state"), F.array_append(acc["out"], r["out"]).alias("out")))

    start = F.struct(state.alias("state"), F.expr(f"cast(array() as array<array<{out}>>)").alias("out"))
    chunks = _let(items, lambda x: F.when(F.size(x) > 0, F.transform(
        F.sequence(F.lit(1), F.size(x), F.lit(CHUNK)), lambda k: F.slice(x, k, CHUNK))))
    return F.coalesce(F.flatten(F.aggregate(chunks, start, outer)["out"]), empty)


def _ibans(runs: Column) -> Column:
    """The IBANs at the start of the runs; of two that overlap the first, or the second if only that is as long as its country's are."""
    found = F.transform(runs, lambda s: F.struct(first_iban(s["match"]).alias("match"), s["start"].alias("start"), s["before"].alias("before")))
    found = F.transform(F.filter(found, lambda s: s["match"].isNotNull()), lambda s: F.struct(
        s["match"].alias("match"), s["start"].alias("start"), (s["start"] + F.length(s["match"])).alias("end"), s["before"].alias("before")))

    def step(state, s):
        apart = s["start"] >= state["at"]
        taken = apart | (usual_length(s["match"]) & ~state["usual"])
        kept = F.struct(s["match"].alias("match"), s["start"].alias("start"), s["end"].alias("end"), s["before"].alias("before"), (~apart).alias("instead"))
        return (F.when(taken, F.struct(s["end"].alias("at"), usual_length(s["match"]).alias("usual"))).otherwise(state),
                F.when(taken, F.array(kept)).otherwise(F.expr(f"cast(array() as array<{PLACED[:-1]},instead:boolean>>)")))

    taken = _scan(found, F.struct(F.lit(0).alias("at"), F.lit(False).alias("usual")), f"{PLACED[:-1]},instead:boolean>", step)
    return _let(taken, lambda all_: F.filter(all_, lambda s, i: ~F.coalesce(F.get(all_, i + 1)["instead"], F.lit(False))))


PLACED = "struct<match:string,start:int,end:int,before:string>"


def _spans(text: Column, kind: str, matches: Column) -> Column:
    """Confirmed spans of one kind, in order of their start."""
    found, between = matches["found"], matches["between"]
    lengths = F.zip_with(found, F.slice(between, 1, F.size(found)), lambda m, gap: F.struct(m.alias("match"), gap.alias("gap")))

    def step(state, x):
        # the pattern of an IBAN takes its first four characters; the match is what it looked ahead at
        own = F.left(x["match"], F.lit(4)) if kind == "iban" else x["match"]
        before = F.right(F.concat(state["before"], x["gap"]), F.lit(CONTEXT))
        at = state["at"] + F.length(x["gap"])
        end = at + F.length(own)
        placed = F.struct(x["match"].alias("match"), at.alias("start"), end.alias("end"), before.alias("before"))
        return (F.struct(end.alias("at"), F.right(F.concat(before, own), F.lit(CONTEXT)).alias("before")), F.array(placed))

    placed = _scan(lengths, F.struct(F.lit(0).alias("at"), F.lit("").alias("before")), PLACED, step)
    placed = _ibans(placed) if kind == "iban" else F.filter(placed, lambda s: valid(kind, s["match"]))

    def scored(s):
        score = F.least(F.lit(1.0), F.lit(SCORES[kind]) + F.when(s["before"].rlike(WORDS[kind]), RAISE).otherwise(0.0))
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), score.alias("score"))

    kept = F.filter(F.transform(placed, scored), lambda s: s["score"] >= THRESHOLD)
    return F.when(F.size(found) > 0, kept).otherwise(F.expr(f"cast(array() as array<{SPAN}>)"))


def find_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``pii``: ``kind, start, end, score`` of every span, by kind as listed, then start."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    columns = docs.columns
    proposed = docs.select("*", *[_matches(text, k).alias(f"__{k}") for k in PATTERNS])
    spans = F.concat(*[F.coalesce(_spans(text, k, F.col(f"__{k}")), F.expr(f"cast(array() as array<{SPAN}>)")) for k in PATTERNS])
    return proposed.select(*[F.col(f"`{c}`") for c in columns], spans.alias("pii"))


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets; overlapping spans give one replacement."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))

    def cut(blocks):
        def piece(start, end):
            # only the blocks that hold the piece are looked at
            first = (start / BLOCK).cast("int")
            held = F.array_join(F.slice(blocks, first + 1, ((end - 1) / BLOCK).cast("int") - first + 1), "")
            return F.when(end > start, F.substring(held, start - first * BLOCK + 1, end - start)).otherwise("")

        def step(at, s):
            part = F.concat(piece(at, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
            return F.greatest(at, s["end"]), F.when(s["start"] >= at, F.array(part)).otherwise(F.expr("cast(array() as array<string>)"))

        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(_scan(ordered, F.lit(0), "string", step), ""), piece(last, F.length(text)))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    return F.when(F.size(spans) > 0, _let(blocks, cut)).otherwise(text)


def of_kind(spans: Column, *kinds: str) -> Column:
    """The spans of the given kinds."""
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

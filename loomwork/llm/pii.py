"""Personal data by fixed patterns and by weak supervision. All is DataFrame functions.

Base spans follow four patterns with their checks. The patterns here are those of the contract with possessive repeats,
and begin only where a run of their first characters begins or the last match ended; they find the same matches in time
linear in the text. So is all else: what is made of a word is made once, places and overlaps come from running sums,
maxima and minima over blocks of a list, and no aggregation holds a list that grows with the text.

Weak supervision adds spans. Candidates are words with a digit, ``@`` or ``=`` in them, and spaced telephone numbers.
Labelers vote on each (yes, no or nothing): a regular expression of known formats, a gazetteer of key words, the word
before, the mixture of characters, decoration, and overlap with a base span. Expectation-maximisation over the counts of
vote patterns in all documents estimates how reliable each labeler is and how probable each pattern is personal data. A
logistic classifier of the span's own features is trained on these probabilities and decides on every candidate; those
that overlap no base span are added.

Votes and features are booleans, so what the driver gets for both trainings has at most one row for each combination,
however large the corpus.

Defined results: a NULL text is empty; rows are read one by one; offsets are code points, ends exclusive. Without any
candidate in the corpus nothing is added.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm.arrow_rows import REST, apart, together
from loomwork.staging import discard, staged

# The patterns and checks of the base spans, in the order of their kinds.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_IP = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$"
#: A text without this has no match.
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}

CANDIDATE = r"(?<!\S)(?:\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])|[^\s0-9@=]*+[0-9@=]\S*+)"
_OPENING, _CLOSING = "\"'([{<", "\"')]}>.,;:!?"
_SHAPES = {
    "email": r"^[^@\s]+@[^@\s]+\.[A-Za-z]{2,}$",
    "phone": r"^\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}$",
    "id": r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$",
}
_KNOWN = r"^(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_\w{20,}|sk-\w{16,}|xox[abp]-[\w-]{10,}|(?i:passw(?:or)?d|pwd|secret|token|api[_-]?key)[=:]\S{6,})$"
_GAZETTEER = r"(?i)(?:passw|passwort|pwd|secret|token|api[_-]?key|akia|asia|ghp_|bearer|@mail|\.com$|\.org$|\.net$|contrase|mot_?de_?passe)"
_BEFORE_YES = r"(?i)^(?:e-?mail|mail|tel|phone|telefon|call|card|karte|tarjeta|carte|ssn|key|password|passwort|secret|token|login|iban)[:.]?$"
_BEFORE_NO = r"(?i)^(?:page|seite|página|chapter|kapitel|vol|version|no|nr|fig|year|jahr|año|année)[.:]?$"

LABELERS = ["known", "gazetteer", "context", "mixture", "plain", "base"]
FEATURES = [
    "has_at", "has_equals", "letters", "capitals", "four_digits", "eight_digits", "twelve_long", "twenty_long",
    "only_number", "decorated", "word_before", "key_word",
]
ROUNDS = 50

_SPAN = "array<struct<start:int,end:int>>"
_CANDIDATE_TYPE = "array<struct<start:int,end:int,kind:string,votes:array<boolean>,features:array<boolean>>>"
#: Entries of a block of a list whose running sums are made: an aggregation copies its state at every step.
_BLOCK = 256


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is made once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column, op, zero: int) -> Column:
    """For each number of a list ``op`` over those before it, from ``zero`` on."""

    def scanned(block: Column) -> Column:
        begin = F.struct(F.array().cast("array<int>").alias("seen"), F.lit(zero).alias("at"))
        return F.aggregate(block, begin, lambda s, x: F.struct(F.concat(s["seen"], F.array(s["at"])).alias("seen"), op(s["at"], x).alias("at")))

    def of_blocks(blocks: Column) -> Column:
        before = scanned(F.transform(blocks, lambda b: b["at"]))["seen"]
        return F.flatten(F.zip_with(blocks, before, lambda b, whole: F.transform(b["seen"], lambda x: op(x, whole))))

    def cut(v: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(v) - 1, F.lit(0)), F.lit(_BLOCK))
        return F.transform(places, lambda i: scanned(F.slice(v, i + 1, F.lit(_BLOCK))))

    return _bound(_bound(values, cut), of_blocks)


def _placed(pieces: Column, size) -> Column:
    """Each piece beside the place where it begins, the sum of the sizes before it."""

    def both(p: Column) -> Column:
        return F.zip_with(p, _running(F.transform(p, size), lambda a, x: a + x, 0), lambda piece, at: F.struct(piece.alias("piece"), at.alias("at")))

    return _bound(pieces, both)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the weighted digit sum ends in 0."""
    n = F.length(digits)

    def weighted(i: Column) -> Column:
        digit = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), weighted), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = F.length(_digits(match))
    return {
        "email": lambda: F.lit(True),
        "ip": lambda: match.rlike(_IP),
        "card": lambda: F.when(digits.between(14, 19), _luhn(_digits(match))).otherwise(False),
        "phone": lambda: digits.between(10, 15),
    }[kind]()


def _matches(text: Column, pattern: str) -> Column:
    """The text between matches, and the match after each; the last has none."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.arrays_zip(between.alias("between"), found.alias("match"))


def _spans(text: Column, kind: str) -> Column:
    def size(piece: Column) -> Column:
        return F.length(piece["between"]) + F.coalesce(F.length(piece["match"]), F.lit(0))

    placed = _placed(_matches(text, PATTERNS[kind]), size)
    good = F.filter(placed, lambda p: F.when(p["piece"]["match"].isNotNull(), _valid(kind, p["piece"]["match"])).otherwise(False))
    found = F.transform(good, lambda p: F.struct((p["at"] + F.length(p["piece"]["between"])).alias("start"), (p["at"] + size(p["piece"])).alias("end")))
    has = text.contains(_NEEDS[kind]) if kind in _NEEDS else text.rlike("[0-9][\x20-]?[0-9]")
    return F.when(has, found).otherwise(F.array().cast(_SPAN))


def _votes(w: Column) -> list[Column]:
    yes, no, nothing = F.lit(True), F.lit(False), F.lit(None).cast("boolean")
    word, before, kind = w["word"], w["before"], w["kind"]
    formatted = word.rlike(_KNOWN) | kind.isin("email", "phone", "id")
    mixed = (w["digits"] >= 4) & (w["length"] >= 10) & word.rlike("[A-Za-z]")
    return [
        F.when(formatted, yes).when(word.rlike(r"^[0-9.,/-]{1,9}$"), no).otherwise(nothing),
        F.when(word.rlike(_GAZETTEER), yes).otherwise(nothing),
        F.when(before.rlike(_BEFORE_YES), yes).when(before.rlike(_BEFORE_NO), no).otherwise(nothing),
        F.when(mixed, yes).otherwise(no),
        F.when(word.rlike(r"[|*#$%&]{2}|^[^A-Za-z]*$|^[0-9]{1,4}[a-z]{0,2}$") & ~kind.isin("phone", "id"), no).otherwise(nothing),
        F.when(w["overlaps"], yes).otherwise(nothing),
    ]


def _features(w: Column) -> list[Column]:
    word, digits, length = w["word"], w["digits"], w["length"]
    return [
        word.contains("@"), word.contains("="), word.rlike("[a-z]"), word.rlike("[A-Z]"), digits >= 4, digits >= 8,
        length >= 12, length >= 20, word.rlike("^[0-9]+$"), word.rlike(r"[|*#$%&]{2}"), w["before"].rlike(_BEFORE_YES),
        word.rlike(_GAZETTEER),
    ]


def _words(text: Column) -> Column:
    """Candidate words in order, without signs around them, and the word before each."""

    def bare(piece: Column) -> Column:
        match, between = F.coalesce(piece["match"], F.lit("")), piece["between"]
        inner = F.ltrim(match, F.lit(_OPENING))
        return F.struct(
            (F.length(between) + F.length(match) - F.length(inner)).alias("gap"), F.rtrim(inner, F.lit(_CLOSING)).alias("word"),
            (F.length(between) + F.length(match)).alias("size"), F.regexp_extract(F.substring(between, -40, 40), r"(\S+)\s*$", 1).alias("before"),
        )

    def word(p: Column) -> Column:
        start = p["at"] + p["piece"]["gap"]
        return F.struct(
            start.alias("start"), (start + F.length(p["piece"]["word"])).alias("end"), p["piece"]["word"].alias("word"), p["piece"]["before"].alias("before")
        )

    placed = _placed(F.transform(_matches(text, CANDIDATE), bare), lambda piece: piece["size"])
    return F.transform(F.filter(placed, lambda p: p["piece"]["word"] != ""), word)


def _overlaps(words: Column, base: Column) -> Column:
    """For each word whether a base span overlaps it."""
    spans = F.transform(base, lambda b: F.struct(b["start"].alias("start"), F.lit(0).alias("word"), b["end"].alias("end")))
    events = F.array_sort(F.concat(spans, F.transform(words, lambda w: F.struct(w["start"].alias("start"), F.lit(1).alias("word"), w["end"].alias("end")))))

    def both(e: Column) -> Column:
        reach = F.transform(e, lambda x: F.when(x["word"] == 0, x["end"]).otherwise(-1))
        begin = F.transform(F.reverse(e), lambda x: F.when(x["word"] == 0, x["start"]).otherwise(2**31 - 1))
        # The furthest end of the spans that begin before the word or with it, and the next begin after it.
        furthest, following = _running(reach, F.greatest, -1), F.reverse(_running(begin, F.least, 2**31 - 1))
        met = F.zip_with(e, F.arrays_zip(furthest.alias("furthest"), following.alias("following")), lambda x, y: F.struct(
            x["word"].alias("word"), ((y["furthest"] > x["start"]) | (y["following"] < x["end"])).alias("overlaps")
        ))
        return F.transform(F.filter(met, lambda x: x["word"] == 1), lambda x: x["overlaps"])

    return F.when(F.size(base) > 0, _bound(events, both)).otherwise(F.transform(words, lambda w: F.lit(False)))


def _candidates(text: Column, base: Column) -> Column:
    """Candidate spans with their kind, votes and features."""

    def kind_of(word: Column) -> Column:
        mixed = word.rlike("[0-9]") & word.rlike("[A-Za-z]") | word.contains("=")
        kind = F.when(mixed, "secret").otherwise("number")
        for name, shape in reversed(_SHAPES.items()):
            kind = F.when(word.rlike(shape), name).otherwise(kind)
        return kind

    def measured(w: Column, overlaps: Column) -> Column:
        return F.struct(
            w["start"].alias("start"), w["end"].alias("end"), w["word"].alias("word"), w["before"].alias("before"), kind_of(w["word"]).alias("kind"),
            F.length(_digits(w["word"])).alias("digits"), F.length(w["word"]).alias("length"), overlaps.alias("overlaps"),
        )

    def judged(w: Column) -> Column:
        return F.struct(
            w["start"].alias("start"), w["end"].alias("end"), w["kind"].alias("kind"), F.array(*_votes(w)).alias("votes"), F.array(*_features(w)).alias("features")
        )

    def of_words(words: Column) -> Column:
        return F.transform(F.zip_with(words, _overlaps(words, base), measured), judged)

    return F.when(text.rlike("[0-9@=]"), _bound(_words(text), of_words)).otherwise(F.array().cast(_CANDIDATE_TYPE))


def _named(kind: str, rank: int):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end"))


def _of_kind(kind: str):
    return lambda c: c["kind"] == kind


def _all_spans(lists: dict[str, Column]) -> Column:
    """Spans of several kinds as ``start, rank, kind, end`` in order of start, then kind."""
    named = [F.transform(spans, _named(kind, rank)) for rank, (kind, spans) in enumerate(lists.items())]
    return F.array_sort(F.concat(*named))


def detected(documents: DataFrame, *carried: str) -> DataFrame:
    """Base spans of each row by kind, and ``candidates``; with ``carried`` columns."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(*carried, text.alias("_text")).withColumns({k: _spans(F.col("_text"), k) for k in PATTERNS})
    return rows.withColumn("candidates", _candidates(F.col("_text"), F.concat(*PATTERNS))).drop("_text")


# Expectation-maximisation over counts of vote patterns; a few dozen rows.
def labeler_reliabilities(patterns: dict[tuple, int], rounds: int = ROUNDS) -> tuple[float, list[dict], dict[tuple, float]]:
    """Share of personal data, each labeler's chance of each vote (yes, no, none) by truth, probability of each pattern.

    Starts from the share of yes among a pattern's votes. Each chance has one vote's worth of smoothing.
    """
    probable = {p: (0.5 + sum(v is True for v in p)) / (1 + sum(v is not None for v in p)) for p in patterns}
    share, chances = 0.5, []
    for _ in range(rounds):
        mass = {True: sum(n * probable[p] for p, n in patterns.items())}
        mass[False] = sum(patterns.values()) - mass[True]
        share = (mass[True] + 1) / (mass[True] + mass[False] + 2)
        chances = []
        for i in range(len(LABELERS)):
            chance = {(t, v): 1.0 for t in (True, False) for v in (True, False, None)}
            for p, n in patterns.items():
                chance[True, p[i]] += n * probable[p]
                chance[False, p[i]] += n * (1 - probable[p])
            chances.append({key: c / (mass[key[0]] + 3) for key, c in chance.items()})
        for p in patterns:
            odds = {t: math.log(share if t else 1 - share) + sum(math.log(c[t, v]) for c, v in zip(chances, p)) for t in (True, False)}
            probable[p] = 1 / (1 + math.exp(min(700.0, odds[False] - odds[True])))
    return share, chances, probable


def span_classifier(examples: list[tuple[tuple, float, int]], rounds: int = 300, rate: float = 1.0, decay: float = 1e-3) -> list[float]:
    """Logistic weights (the first is the constant) from distinct feature rows with soft labels and counts."""
    weights, total = [0.0] * (len(FEATURES) + 1), sum(n for _, _, n in examples)
    for _ in range(rounds):
        slope = [decay * w for w in weights]
        for features, label, n in examples:
            score = weights[0] + sum(w for w, f in zip(weights[1:], features) if f)
            error = (1 / (1 + math.exp(-max(-700.0, min(700.0, score)))) - label) * n / total
            slope[0] += error
            for i, f in enumerate(features, 1):
                slope[i] += error * f
        weights = [w - rate * s for w, s in zip(weights, slope)]
    return weights


def trained_weights(found: DataFrame) -> list[float] | None:
    """Weights of the span classifier from all candidates of ``found``; None where there are none."""
    counted = found.select(F.explode("candidates").alias("c")).groupBy("c.votes", "c.features").count()
    rows = [(tuple(row["votes"]), tuple(row["features"]), row["count"]) for row in counted.collect()]
    if not rows:
        return None
    patterns: dict[tuple, int] = {}
    for votes, _, n in rows:
        patterns[votes] = patterns.get(votes, 0) + n
    probable = labeler_reliabilities(patterns)[2]
    return span_classifier(sorted((features, probable[votes], n) for votes, features, n in rows))


def _added(weights: list[float] | None) -> dict[str, Column]:
    """Candidates the classifier takes, by kind, that overlap no base span."""
    if weights is None:
        return {}

    def taken(c: Column) -> Column:
        score = reduce(lambda a, b: a + b, [F.when(c["features"][i], w).otherwise(0.0) for i, w in enumerate(weights[1:])])
        return (score + weights[0] > 0) & ~c["votes"][LABELERS.index("base")].eqNullSafe(F.lit(True))

    chosen = F.filter("candidates", taken)
    return {kind: F.filter(chosen, _of_kind(kind)) for kind in ("email", "phone", "id", "secret")}


def _with_spans(found: DataFrame, weights: list[float] | None) -> DataFrame:
    """``base`` and ``spans`` in place of the spans by kind: arrays of ``start, rank, kind, end``."""
    base = {kind: F.col(kind) for kind in PATTERNS}
    added = _added(weights)
    every = {k: F.concat(base[k], F.transform(added[k], lambda c: F.struct(c["start"], c["end"]))) if k in added else base[k] for k in base}
    every |= {k: v for k, v in added.items() if k not in base}
    return found.withColumns({"base": _all_spans(base), "spans": _all_spans(every)})


def personal_data(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, the base spans by kind, ``base`` and ``spans`` (arrays of start, rank, kind, end)."""
    found = staged(detected(documents, "doc_id"))
    return _with_spans(found, trained_weights(found)).drop("candidates")


def as_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(documents: DataFrame) -> DataFrame:
    """``documents`` with the same columns and rows, every span of personal data replaced by ``[KIND]``."""
    trained = staged(detected(documents).select("candidates"))
    weights = trained_weights(trained)
    discard(trained)
    rows = _with_spans(detected(apart(documents), REST, "text"), weights)

    def cut(state: Column, s: Column) -> Column:
        # A span that begins inside the last one only moves its end.
        kept = F.substring("text", state["at"] + 1, s["start"] - state["at"])
        mark = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        out = F.when(s["start"] >= state["at"], F.concat(state["out"], F.array(kept, mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    def rest(state: Column) -> Column:
        return F.concat(F.array_join(state["out"], ""), F.substring("text", state["at"] + 1, F.length("text")))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    text = F.when(F.size("spans") > 0, F.aggregate("spans", empty, cut, rest)).otherwise(F.col("text"))
    return together(rows, documents, text)

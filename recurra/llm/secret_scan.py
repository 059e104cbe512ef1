"""Secret scans: fixed patterns, and Markov models of random strings and ordinary identifiers.

Base spans follow three fixed patterns (``KINDS``). The method adds spans of
kind ``markov``: a token of ``TOKEN_CHARS`` or more token characters outside
base spans is split from its text, and two character models of first order score it, one of random
strings and one of ordinary identifiers. The token is a span if the mean
log-likelihood ratio of its character pairs exceeds ``threshold``. If it does
not, its runs of ``TOKEN_CHARS`` or more characters whose mean does are spans,
so that a random string joined to a key or a path is found (``Models.runs``).

Both models are trained from labelled samples of the corpus itself, over all
documents: the values of base spans are labelled random; tokens of
``SAMPLE_CHARS`` or more characters in which no letter touches a digit (words,
numbers, dates, and these joined by separators) are labelled ordinary. Digits
after digits are ordinary by a prior, whether or not the corpus has numbers, and
pairs with a separator say nothing, as strings of both kinds are joined by them;
a capital after a small letter, as in joined names, counts ``JOINED`` at most.
Training is one grouped count of character pairs; its result has at most
``PAIRS`` rows a label, which the driver smooths and turns into one constant array.

Matches of one pattern are leftmost and do not overlap, as the pattern engine
finds them; positions come from the lengths of the matches and of the parts
between them, so everything runs on built-in column functions. A text is first
cut into the stretches that may hold a match; positions are summed, and texts
cut, in blocks, so that the work on a long text grows nearly as its length.

Rows: a null or empty text has no span. Repeated rows give equal results, an
empty table an empty one (and models of pure smoothing, which score every pair
0). Very long texts are scanned whole. Other columns are not read, and kept as they
are; one named like the result is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.llm.common import let

# The base patterns. Group 2 of assign is the value. The engine's
# (?i) folds ASCII letters only.
ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{16,}"      # AKIA and more, 20 characters in all
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
MIN_VALUE = 6

# What may hold a match or a token: their characters, and a space beside another space, a colon or an
# equals sign. Possessive, as a repeated group would else take stack for every character.
STRETCH_CHARS = "A-Za-z0-9+/_.=:\"'-"
STRETCH = (f"(?<![{STRETCH_CHARS}])(?:[{STRETCH_CHARS}]|\\x20(?=[\\x20:=])|(?<=[\\x20:=])\\x20)"
           "{12,}+")              # no span kept is shorter than 12 characters

# Token characters of the models, in the order of their codes.
SEPARATORS = "+/_=-"
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + SEPARATORS
DIGITS = 10
TOKEN_CHARS = 16
SAMPLE_CHARS = 12    # ordinary samples: more of them, and so a sharper model, than from whole tokens
PAIRS = len(ALPHABET) ** 2
THRESHOLD = 0.8      # nats a character pair
SMOOTHING = 0.5
BACKOFF = 20.0       # pairs that a character's successors borrow from the frequencies of single characters
DROP = 16.0          # nats that a run may fall below its best end before it is closed
JOINED = 1.0         # nats at most for a capital after a small letter
BLOCK = 128          # array entries handled together

SPAN = "array<struct<start:int,kind:int,end:int>>"
MATCHES = "array<struct<start:int,end:int,piece:string>>"


def _running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Running results of ``op`` over an array of non-negative integers, started at 0.

    Arrays grow by copying, so they grow inside blocks only: first over each
    block, then over the blocks' last results.
    """
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def grow(part: Column) -> Column:
        return F.aggregate(part, start, lambda a, x: F.struct(
            op(a["at"], x).alias("at"), F.concat(a["out"], F.array(op(a["at"], x))).alias("out")), lambda a: a["out"])

    def whole(blocks: Column) -> Column:
        before = grow(F.transform(blocks, lambda b: F.coalesce(F.get(b, F.size(b) - 1), F.lit(0))))
        return let(before, lambda t: F.flatten(F.transform(blocks, lambda b, i: F.transform(
            b, lambda x: op(F.coalesce(F.get(t, i - 1), F.lit(0)), x)))))

    return let(values, lambda v: let(F.transform(_blocks(v, BLOCK), grow), whole))


def _blocks(values: Column, size: int) -> Column:
    """An array as an array of arrays of ``size`` entries, the last of the rest."""
    last = F.floor((F.size(values) - 1) / size).cast("int")
    return F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda b: F.slice(values, b * size + 1, F.lit(size)))


def _matches(text: Column, pattern: str, value_group: int | None = None) -> Column:
    """(start, end, piece) of all matches of a pattern; with ``value_group``, of those whose group is long enough."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    parts = [found.alias("match"), F.slice(between, 1, F.size(found)).alias("before")]
    if value_group:
        parts.append(F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("value"))

    def placed(parts: Column) -> Column:
        ends = _running(F.transform(parts, lambda x: F.length(x["before"]) + F.length(x["match"])), lambda a, x: a + x)
        spans = let(ends, lambda e: F.transform(parts, lambda x, i: F.struct(
            (F.get(e, i) - F.length(x["match"])).alias("start"), F.get(e, i).alias("end"), x["match"].alias("piece"),
            (F.length(x["value"]) >= MIN_VALUE if value_group else F.lit(True)).alias("held"))))
        return F.transform(F.filter(spans, lambda s: s["held"]), lambda s: F.struct(s["start"], s["end"], s["piece"]))

    return F.when(text.rlike(pattern), let(F.arrays_zip(*parts), placed)).otherwise(F.array().cast(MATCHES))


def _gaps(spans: Column, length: Column) -> Column:
    """The ranges (start, end) before each span that begins at or after the ends of all before it, and the last one."""
    def between(reach: Column) -> Column:
        before = F.transform(spans, lambda s, i: F.struct(F.coalesce(F.get(reach, i - 1), F.lit(0)).alias("start"),
                                                          s["start"].alias("end")))
        last = F.struct(F.coalesce(F.get(reach, F.size(spans) - 1), F.lit(0)).alias("start"), length.alias("end"))
        return F.concat(F.filter(before, lambda r: r["start"] <= r["end"]), F.array(last))

    return let(_running(F.transform(spans, lambda s: s["end"]), lambda a, x: F.greatest(a, x)), between)


def _pieces(text: Column, ranges: Column, levels: int = 2) -> Column:
    """The text at ascending ranges (start, end).

    A substring is counted off from the start of its string, so the text is
    first cut into the stretches of many ranges, these into those of fewer.
    """
    if levels == 0:
        return F.transform(ranges, lambda r: F.substring(text, r["start"] + 1, r["end"] - r["start"]))

    def inner(group: Column) -> Column:
        at, end = F.get(group, 0)["start"], F.get(group, F.size(group) - 1)["end"]
        moved = F.transform(group, lambda r: F.struct((r["start"] - at).alias("start"), (r["end"] - at).alias("end")))
        return let(F.struct(F.substring(text, at + 1, end - at).alias("text"), moved.alias("ranges")),
                   lambda x: _pieces(x["text"], x["ranges"], levels - 1))

    return F.flatten(F.transform(_blocks(ranges, BLOCK ** levels), inner))


def _stretches(text: Column, token_chars: int = TOKEN_CHARS) -> Column:
    """(start, end, piece) of the stretches of a text that may hold a span.

    No match of a base pattern and no token goes beyond a stretch, so each is
    looked at alone and positions inside it are counted from its own start.
    """
    kept = "|".join(["(?i:password|passwd|secret|token|api_?key)", "AKIA", "[0-9a-f]{24}",
                     f"[0-9A-Za-z+/_=-]{{{token_chars}}}"])
    return F.filter(_matches(text, STRETCH), lambda x: x["piece"].rlike(kept))


def _base(text: Column) -> Column:
    """(start, kind, end, piece) of the base spans of a text, by start and kind."""
    def of(pattern: str, kind: int, group: int | None = None) -> Column:
        return F.transform(_matches(text, pattern, group), lambda m: F.struct(
            m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"), m["piece"].alias("piece")))

    return F.array_sort(F.concat(of(ASSIGN, 0, 2), of(ACCESS, 1), of(HEX, 2)))


def _tokens(text: Column, base: Column, token_chars: int = TOKEN_CHARS) -> Column:
    """The tokens of a text, cut at the bounds of its base spans: what stands between these is a token of its own."""
    pattern = f"[0-9A-Za-z+/_=-]{{{token_chars},}}"

    def inside(ranges: Column) -> Column:
        return F.flatten(F.zip_with(ranges, _pieces(text, ranges), lambda r, piece: F.transform(
            _matches(piece, pattern), lambda m: F.struct((r["start"] + m["start"]).alias("start"),
                                                         (r["start"] + m["end"]).alias("end"), m["piece"].alias("piece")))))

    return F.when(F.size(base) > 0, let(_gaps(base, F.length(text)), inside)).otherwise(_matches(text, pattern))


def _moved(span: Column, by: Column) -> Column:
    return F.struct((span["start"] + by).alias("start"), span["kind"].alias("kind"), (span["end"] + by).alias("end"))


def _pairs(token: Column) -> Column:
    """Codes of the adjacent character pairs of a token."""
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    k = len(ALPHABET)
    return let(F.filter(codes, lambda c: c >= 0), lambda good: F.transform(
        F.slice(good, 2, F.size(good)), lambda c, i: F.get(good, i).cast("int") * k + c))


def samples(texts: DataFrame) -> DataFrame:
    """(label, token) of the distinct labelled samples of column ``text``; label 1 random, 0 ordinary."""
    value = F.regexp_replace(F.col("s.piece"), "^((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?", "")
    held = (texts.select(F.explode(_stretches(F.col("text"), SAMPLE_CHARS)).alias("x"))
            .select(F.col("x.piece").alias("text"), _base(F.col("x.piece")).alias("base"))
            .select("base", _tokens(F.col("text"), F.col("base"), SAMPLE_CHARS).alias("tokens"))
            .select(F.explode(F.concat(*[F.transform(of, lambda s: F.struct(F.lit(label).alias("label"), s["piece"].alias("piece")))
                                         for label, of in ((1, "base"), (0, "tokens"))])).alias("s")))
    ordinary = ~F.col("s.piece").rlike("[0-9][A-Za-z]|[A-Za-z][0-9]") & F.col("s.piece").rlike("[0-9A-Za-z]")
    return (held.where((F.col("s.label") == 1) | ordinary)
            .select("s.label", F.when(F.col("s.label") == 1, value).otherwise(F.col("s.piece")).alias("token")).distinct())


def pair_counts(texts: DataFrame) -> DataFrame:
    """(label, pair, n) of the labelled samples of column ``text``.

    Samples are grouped before their pairs are counted, so a string copied a
    million times costs one row; each distinct string counts once, as copies
    would tie the model to a few strings. Ordinary samples count in capitals,
    too, since identifiers come in both.
    """
    token = F.col("token")
    both = F.when(F.col("label") == 0, F.concat(_pairs(token), _pairs(F.upper(token)))).otherwise(_pairs(token))
    return (samples(texts).select("label", F.explode(both).alias("pair"))
            .groupBy("label", "pair").agg(F.count("*").alias("n")))


def _to_blocks(token: Column, run: Column) -> Column:
    """The run, moved to the ends of the blocks of letters and digits it begins and ends in.

    The ends of a random string may score low, so a block is taken whole; but one
    of which the run has less than half, past a separator, is left.
    """
    inside = F.substring(token, run["start"] + 1, run["end"] - run["start"])
    left = F.length(F.regexp_extract(F.substring(token, F.lit(1), run["start"]), "[0-9A-Za-z]*$", 0))
    right = F.length(F.regexp_extract(F.substring(token, run["end"] + 1, F.length(token)), "^[0-9A-Za-z]*", 0))
    head, head_cut = (F.length(F.regexp_extract(inside, "^([0-9A-Za-z]*)[+/_=-]+", k)) for k in (1, 0))
    tail, tail_cut = (F.length(F.regexp_extract(inside, "[+/_=-]+([0-9A-Za-z]*)$", k)) for k in (1, 0))
    start = run["start"] + F.when((head_cut > 0) & (head < left), head_cut).otherwise(-left)
    end = run["end"] + F.when((tail_cut > 0) & (tail < right), -tail_cut).otherwise(right)
    return let(F.struct(start.alias("start"), end.alias("end")), lambda b: F.when(b["start"] < b["end"], b).otherwise(
        F.struct((run["start"] - left).alias("start"), (run["end"] + right).alias("end"))))


def _merged(spans: Column) -> Column:
    """Spans in order, with those that overlap made one."""
    def add(acc: Column, s: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        joined = F.struct(F.least(last["start"], s["start"]).alias("start"), s["kind"].alias("kind"),
                          F.greatest(last["end"], s["end"]).alias("end"))
        return F.when((F.size(acc) > 0) & (s["start"] < last["end"]),
                      F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(joined))).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(F.array_sort(spans), F.array().cast(SPAN), add)


def _most(a: str, b: str) -> float:
    """The greatest ratio of a pair: strings of both kinds are joined by separators, names also by capitals."""
    return 0.0 if a in SEPARATORS or b in SEPARATORS else JOINED if a.islower() and b.isupper() else math.inf


class Models:
    """The log-likelihood ratio of every character pair, random against ordinary."""

    def __init__(self, counts: dict[tuple[int, int], int], smoothing: float = SMOOTHING):
        k = len(ALPHABET)
        digits = range(DIGITS)
        logp = []
        for label in (0, 1):
            seen = [[counts.get((label, a * k + b), 0) for b in range(k)] for a in range(k)]
            total = sum(map(sum, seen)) + smoothing * k
            # a character that was rare after any other is unlikely after one that was never seen, too
            single = [(sum(row[b] for row in seen) + smoothing) / total for b in range(k)]
            if label:       # random strings may use other characters than the sampled ones
                single = [(p + 1 / k) / 2 for p in single]
            # numbers are ordinary, whether or not the corpus has any
            number = [0.9 / DIGITS + 0.1 * p if b in digits else 0.1 * p for b, p in enumerate(single)]
            logp.append([math.log((n + BACKOFF * p) / (sum(row) + BACKOFF)) for a, row in enumerate(seen)
                         for n, p in zip(row, number if not label and a in digits else single)])
        most = [_most(a, b) for a in ALPHABET for b in ALPHABET]
        self.ratio = [min(r - o, m) if counts and m else 0.0 for o, r, m in zip(*logp, most)]

    @staticmethod
    def train(texts: DataFrame, smoothing: float = SMOOTHING) -> "Models":
        """Models from the labelled samples of column ``text``."""
        return Models({(r["label"], r["pair"]): r["n"] for r in pair_counts(texts).collect()}, smoothing)

    def _ratios(self, token: Column) -> Column:
        table = F.split(F.lit(",".join(f"{x:.6f}" for x in self.ratio)), ",").cast("array<double>")
        return F.transform(_pairs(token), lambda p: F.get(table, p))

    def score(self, token: Column) -> Column:
        """Mean log-likelihood ratio of a token's character pairs; 0 without a pair."""
        total = F.aggregate(self._ratios(token), F.lit(0.0), lambda a, x: a + x)
        return F.when(F.length(token) > 1, total / (F.length(token) - 1)).otherwise(F.lit(0.0))

    def runs(self, token: Column, threshold: float) -> Column:
        """(start, end) of the runs of ``TOKEN_CHARS`` or more characters whose mean ratio exceeds ``threshold``.

        One pass over the sums of ratio minus threshold. A run goes from the least
        sum so far to the greatest rise above it; it is closed when the sum falls
        ``DROP`` below that end or under its start, and the next one begins after it.
        The best run after the end of the one still open is kept too: it stands when
        the open one closes without reaching it.
        """
        far, back = F.lit(float("inf")), TOKEN_CHARS - 1
        nothing = F.struct(far.alias("low"), F.lit(0).alias("at"), F.lit(0.0).alias("best"), F.lit(-1).alias("first"),
                           F.lit(-1).alias("last"))
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("sum_back"), F.lit(0).alias("floor"),
                         nothing.alias("open"), nothing.alias("after"),
                         F.array().cast("array<struct<start:int,end:int>>").alias("runs"))

        def grow(run: Column, s: Column, floor: Column) -> Column:
            """The run with its least start moved to ``s.back`` if lower, and its end to ``s.here`` if higher."""
            lower = (s["back"] >= floor) & (s["sum_back"] < run["low"])
            moved = F.struct(F.when(lower, s["sum_back"]).otherwise(run["low"]).alias("low"),
                             F.when(lower, s["back"]).otherwise(run["at"]).alias("at"))

            def ended(m: Column) -> Column:
                rise = s["sum"] - m["low"]
                more = rise > run["best"]
                return F.struct(m["low"].alias("low"), m["at"].alias("at"),
                                F.when(more, rise).otherwise(run["best"]).alias("best"),
                                F.when(more, m["at"]).otherwise(run["first"]).alias("first"),
                                F.when(more, s["here"]).otherwise(run["last"]).alias("last"))
            return let(moved, ended)

        def closed(runs: Column, run: Column) -> Column:
            return F.when(run["last"] >= 0, F.concat(runs, F.array(F.struct(
                run["first"].alias("start"), (run["last"] + 1).alias("end"))))).otherwise(runs)

        def step(acc: Column, e: Column) -> Column:
            s = F.struct((acc["sum"] + e["x"]).alias("sum"), (acc["sum_back"] + F.coalesce(e["old"], F.lit(0.0))).alias("sum_back"),
                         (e["i"] + 1).alias("here"), (e["i"] + 1 - back).alias("back"))

            def with_sums(s: Column) -> Column:
                def with_open(run: Column) -> Column:
                    after = F.when(run["last"] == s["here"], nothing).when(run["last"] >= 0, grow(
                        acc["after"], s, run["last"])).otherwise(nothing)
                    falls = (run["last"] >= 0) & (s["sum"] - run["low"] < F.greatest(run["best"] - DROP, F.lit(0.0)))
                    return let(after, lambda b: F.struct(
                        s["sum"].alias("sum"), s["sum_back"].alias("sum_back"),
                        F.when(falls & (b["last"] < 0), s["here"]).otherwise(acc["floor"]).alias("floor"),
                        F.when(falls, F.when(b["last"] >= 0, b).otherwise(nothing)).otherwise(run).alias("open"),
                        F.when(falls, nothing).otherwise(b).alias("after"),
                        F.when(falls, closed(acc["runs"], run)).otherwise(acc["runs"]).alias("runs")))
                return let(grow(acc["open"], s, acc["floor"]), with_open)
            return let(s, with_sums)

        excess = F.transform(self._ratios(token), lambda x: x - threshold)
        steps = let(excess, lambda xs: F.transform(xs, lambda x, i: F.struct(
            x.alias("x"), F.get(xs, i - back).alias("old"), i.alias("i"))))
        return F.aggregate(steps, start, step, lambda acc: closed(closed(acc["runs"], acc["open"]), acc["after"]))

    def random_spans(self, tokens: Column, threshold: float) -> Column:
        """Spans of kind markov among the tokens of a text: whole tokens, or runs in their blocks."""
        def spans(t: Column) -> Column:
            whole = F.array(F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")))
            inner = F.transform(self.runs(t["piece"], threshold), lambda r: let(_to_blocks(t["piece"], r), lambda b: F.struct(
                (t["start"] + b["start"]).alias("start"), F.lit(3).alias("kind"), (t["start"] + b["end"]).alias("end"))))
            return F.when(self.score(t["piece"]) > threshold, whole).otherwise(_merged(inner))

        return F.flatten(F.transform(tokens, spans))


def scan(docs: DataFrame, text: str = "text", models: Models | None = None, threshold: float = THRESHOLD,
         keep: list[str] | None = None, column: str = "secret_spans") -> DataFrame:
    """The kept columns of every row and its spans: an array of (start, kind, end) by start and kind.

    Positions are code points, ends exclusive; ``kind`` indexes ``KINDS``. A
    markov span never overlaps a base span. Without ``models`` they are trained
    on ``docs`` first.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    if models is None:
        models = Models.train(docs.select(t.alias("text")))
    row = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep) if c != column]

    # one step a level: expressions nested deeper take the analyzer too many rounds
    found = docs.select(F.struct(*row).alias("row"), _stretches(t).alias("found"))
    found = found.select("row", F.transform("found", lambda x: F.struct(
        x["start"].alias("at"), x["piece"].alias("piece"), _base(x["piece"]).alias("base"))).alias("found"))
    found = found.select("row", F.transform("found", lambda x: F.struct(
        x["at"].alias("at"), x["base"].alias("base"), _tokens(x["piece"], x["base"]).alias("tokens"))).alias("found"))
    spans = F.array_sort(F.flatten(F.transform("found", lambda x: F.transform(F.concat(
        F.transform(x["base"], lambda s: _moved(s, F.lit(0))), models.random_spans(x["tokens"], threshold)),
        lambda s: _moved(s, x["at"])))))
    return found.select("row", spans.cast(SPAN).alias("spans")).select("row.*", F.col("spans").alias(column))


def digest(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """The text with every span replaced by ``mask``; overlapping spans give one mask."""
    return F.when(F.size(spans) > 0, let(_gaps(spans, F.length(text)), lambda r: F.array_join(_pieces(text, r), mask))) \
        .otherwise(text)

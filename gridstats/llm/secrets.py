"""Secrets in texts: known patterns, and tokens that a battery of randomness tests cannot tell from noise.

A candidate is a token of letters and digits whose characters fit an encoding. Against the alphabet of that
encoding it is tested for even use of the symbols (chi-squared), for the number of runs above and below the
middle of the alphabet, and for serial correlation of neighbours; the least of the three p-values, times
three, is its own. Random tokens have even p-values; words, names and numbers have small ones, the sooner
the longer they are. So thresholds are set per encoding and class of length: what lies above a threshold
beyond an even share of what lies above one half is taken for false, and the lowest threshold with a false
share within the bound holds. Expressions only; the texts themselves are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.shared import kept

KINDS = ("assign", "access", "hex")  # in the order in which spans of one start are listed
NOISE = "noise"

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # runs of 20 characters or more, AKIA among them
HEX = r"[0-9a-f]{24,}"
ASSIGN_SIZE = 6
_KEYWORD = r"(?i)passw|secret|token|api_?key"
_LONG_RUN = r"[A-Za-z0-9+/_-]{20}"
_TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,6}"

_DIGITS, _SMALL, _CAPITAL = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Encoding:
    shape: str  # of a whole token
    needs: tuple[str, ...]  # classes it has a character of
    alphabet: str  # symbols in order


# The first that fits holds.
ENCODINGS = {
    "hex": Encoding("^[0-9a-f]+$", ("[0-9]", "[a-f]"), _DIGITS + "abcdef"),
    "hex_capital": Encoding("^[0-9A-F]+$", ("[0-9]", "[A-F]"), _DIGITS + "ABCDEF"),
    "base32": Encoding("^[A-Z2-7]+={0,6}$", ("[2-7]", "[A-Z]"), _CAPITAL + "234567"),
    "base36": Encoding("^[0-9a-z]+$", ("[0-9]", "[a-z]"), _DIGITS + _SMALL),
    "base36_capital": Encoding("^[0-9A-Z]+$", ("[0-9]", "[A-Z]"), _DIGITS + _CAPITAL),
    "base62": Encoding("^[0-9A-Za-z]+$", ("[0-9]", "[a-z]", "[A-Z]"), _DIGITS + _CAPITAL + _SMALL),
    "base64": Encoding("^[0-9A-Za-z+/]+={0,2}$", ("[0-9]", "[a-z]", "[A-Z]"), _CAPITAL + _SMALL + _DIGITS + "+/"),
    "base64_url": Encoding("^[0-9A-Za-z_-]+={0,2}$", ("[0-9]", "[a-z]", "[A-Z]"), _CAPITAL + _SMALL + _DIGITS + "-_"),
}
_CLASSES = 31  # of length, by the power of two
_STEPS = 50  # p-values are counted in steps of a fiftieth


_PART = 256  # spans placed at a time


def _spans(text: Column, pattern: str) -> Column:
    """``start, end, found`` of the matches, leftmost and not overlapping, in code points.

    Lengths are summed over the matches and what lies between them, in parts, as adding to an array copies it.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), lambda s: F.length(s))

    def steps(found: Column, between: Column) -> Column:
        pairs = F.zip_with(
            F.slice(between, F.lit(1), F.size(found)),
            found,
            lambda b, f: F.struct(b.alias("before"), F.length(f).alias("size"), f.alias("found")),
        )
        firsts = F.filter(F.sequence(F.lit(0), F.size(found), F.lit(_PART)), lambda i: i < F.size(found))
        return _let(pairs, lambda p: F.transform(firsts, lambda i: F.slice(p, i + 1, F.lit(_PART))))

    def whole(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda n, p: n + p["before"] + p["size"])

    def add_offset(done: Column, size: Column) -> Column:
        return F.struct(
            (done["at"] + size).alias("at"), F.concat(done["all"], F.array(done["at"])).alias("all")
        )

    def offsets(parts: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
        return F.aggregate(F.transform(parts, whole), zero, add_offset, lambda done: done["all"])

    def place(done: Column, pair: Column) -> Column:
        start = done["at"] + pair["before"]
        end = start + pair["size"]
        span = F.struct(start.alias("start"), end.alias("end"), pair["found"].alias("found"))
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    def placed(part: Column, at: Column) -> Column:
        none = F.array().cast("array<struct<start:int,end:int,found:string>>")
        zero = F.struct(at.alias("at"), none.alias("spans"))
        return F.aggregate(part, zero, place, lambda done: done["spans"])

    parts = _let(F.struct(found.alias("f"), between.alias("b")), lambda x: steps(x["f"], x["b"]))
    return F.flatten(_let(parts, lambda p: F.zip_with(p, offsets(p), placed)))


def _kind(number: int, spans: Column) -> Column:
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"))
    )


def _none(shape: str) -> Column:
    return F.array().cast(f"array<struct<{shape}>>")


_SPAN = "start:int,kind:int,end:int"


def base_spans(text: Column) -> Column:
    """Spans of the known patterns, ``start, kind, end`` sorted; ``kind`` counts through ``KINDS``.

    A text without a keyword, or without a run of 20 characters, is not searched for what needs one.
    """
    assigned = F.filter(
        _spans(text, ASSIGN),
        lambda s: F.length(F.regexp_extract(s["found"], ASSIGN, 2)) >= ASSIGN_SIZE,
    )
    keyed = F.when(text.rlike(_KEYWORD), _kind(0, assigned)).otherwise(_none(_SPAN))
    runs = F.concat(_kind(1, _spans(text, ACCESS)), _kind(2, _spans(text, HEX)))
    long_ = F.when(text.rlike(_LONG_RUN), runs).otherwise(_none(_SPAN))
    return F.array_sort(F.concat(keyed, long_))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def normal_tail(z: Column) -> Column:
    """Probability above ``z`` of a standard normal, to 1e-7 (a rational approximation of the error function)."""

    def half(z: Column) -> Column:
        x = F.abs(z) / F.sqrt(F.lit(2.0))

        def series(t: Column) -> Column:
            # Coefficients of the approximation.
            return t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))

        above = _let(1 / (1 + 0.3275911 * x), series) * F.exp(-x * x) / 2
        return F.when(z >= 0, above).otherwise(1 - above)

    return _let(z, half)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def chi_squared_p(token: Column, alphabet: Column) -> Column:
    """P-value of the chi-squared test of an even use of the symbols (Wilson and Hilferty's approximation)."""
    n, k = F.length(token).cast("double"), F.length(alphabet).cast("double")
    squares = _total(
        F.transform(F.split(alphabet, ""), lambda c: F.pow(n - F.length(F.replace(token, c, F.lit(""))), F.lit(2.0)))
    )
    spread = 2.0 / (9 * (k - 1))
    return normal_tail((F.cbrt((squares * k / n - n) / (k - 1)) - (1 - spread)) / F.sqrt(spread))


def runs_p(token: Column, alphabet: Column) -> Column:
    """Two-sided p-value of the number of runs of symbols of the lower and the upper half of the alphabet."""
    half = F.floor(F.length(alphabet) / 2).cast("int")
    halves = F.concat(F.repeat(F.lit("0"), half), F.repeat(F.lit("1"), F.length(alphabet) - half))

    def score(bits: Column) -> Column:
        n = F.length(bits).cast("double")
        ones = n - F.length(F.replace(bits, F.lit("1"), F.lit("")))
        changes = sum((n - F.length(F.replace(bits, F.lit(c), F.lit("")))) / 2 for c in ("01", "10"))

        def z(both: Column) -> Column:
            spread = F.sqrt(both * (both - n) / (n * n * (n - 1)))
            return F.abs(F.try_divide(changes + 1 - (both / n + 1), spread))

        return _let(2 * ones * (n - ones), z)

    z = _let(F.call_function("translate", token, alphabet, halves), score)
    return F.coalesce(2 * normal_tail(z), F.lit(0.0))


def serial_p(token: Column, alphabet: Column) -> Column:
    """Two-sided p-value of the correlation of each symbol's place in the alphabet with the next one's."""
    places = F.transform(F.split(token, ""), lambda c: F.instr(alphabet, c).cast("double"))
    n = F.length(token).cast("double")

    def centred(x: Column) -> Column:
        return _let(_total(x) / n, lambda mean: F.transform(x, lambda a: a - mean))

    def correlation(x: Column) -> Column:
        products = F.zip_with(x, F.slice(x, F.lit(2), F.size(x)), lambda a, b: F.coalesce(a * b, F.lit(0.0)))
        return F.try_divide(_total(products), _total(F.transform(x, lambda a: a * a)))

    r = _let(_let(places, centred), correlation)
    return F.coalesce(2 * normal_tail(F.abs((r + 1 / n) * F.sqrt(n))), F.lit(0.0))


def battery_p(token: Column, alphabet: Column) -> Column:
    """Three times the least p-value of the three tests, at most 1; ``token`` holds the alphabet's symbols only."""
    least = F.least(chi_squared_p(token, alphabet), runs_p(token, alphabet), serial_p(token, alphabet))
    return F.least(F.lit(1.0), 3 * least)


def _tested(spans: Column) -> Column:
    """``start, end, stratum, p`` of the tokens that fit an encoding; padding is not tested."""
    alphabets = F.array(*[F.lit(e.alphabet) for e in ENCODINGS.values()])

    def encoding(token: Column) -> Column:
        number = F.lit(None).cast("int")
        for i, e in reversed(list(enumerate(ENCODINGS.values()))):
            fits = token.rlike(e.shape)
            for need in e.needs:
                fits = fits & token.rlike(need)
            number = F.when(fits, i).otherwise(number)
        return number

    def one(known: Column) -> Column:
        span, token = known["span"], F.rtrim(known["span"]["found"], F.lit("="))
        length = F.floor(F.log2(F.length(token))).cast("int")
        p = battery_p(token, F.element_at(alphabets, known["number"] + 1))
        stratum = known["number"] * _CLASSES + length
        return F.struct(span["start"].alias("start"), span["end"].alias("end"), stratum.alias("stratum"), p.alias("p"))

    numbered = F.transform(spans, lambda s: F.struct(s.alias("span"), encoding(s["found"]).alias("number")))
    return F.transform(F.filter(numbered, lambda s: s["number"].isNotNull()), one)


@dataclass(frozen=True)
class Thresholds:
    """The lowest p-value taken for noise, per encoding and class of length; no entry, nothing is taken."""

    of: Mapping[int, float] = field(default_factory=dict)

    def accepts(self, span: Column) -> Column:
        if not self.of:
            return F.lit(False)
        pairs = [F.lit(x) for stratum, p in sorted(self.of.items()) for x in (int(stratum), float(p))]
        return F.coalesce(span["p"] >= F.try_element_at(F.create_map(*pairs), span["stratum"]), F.lit(False))


def false_share_thresholds(tokens: DataFrame, most: float = 0.05) -> Thresholds:
    """Thresholds from all ``tokens (stratum, p)`` of a corpus.

    Twice the tokens with a p-value above one half would be random if all of those were; random ones fall
    evenly on all p-values. Above a threshold, whatever is more than their even share counts as false. The
    lowest threshold in steps of a fiftieth, up to one half, whose false share is ``most`` or less is taken.
    The driver gets a row for each stratum, at most ``len(ENCODINGS) * 31``.
    """
    above = [F.count_if(F.col("p") >= i / _STEPS).alias(f"n{i}") for i in range(1, _STEPS // 2 + 1)]
    made = {}
    for row in tokens.groupBy("stratum").agg(*above).collect():
        even = 2 * row[f"n{_STEPS // 2}"] / _STEPS
        for i in range(1, _STEPS // 2 + 1):
            n = row[f"n{i}"]
            if n and n - even * (_STEPS - i) <= most * n:
                made[row["stratum"]] = i / _STEPS
                break
    return Thresholds(made)


def scan_secrets(
    docs: DataFrame, most_false: float = 0.05, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: ``doc_id, spans``, an array of ``start, kind, end`` in code points, ends exclusive.

    ``kind`` counts through ``KINDS``, the known patterns; ``len(KINDS)`` is a token that passes the
    battery and overlaps no known one. Spans are sorted by start and kind. A null or empty text has none.
    Rows with equal texts, or all alike, get equal spans; an empty table gives no rows; columns other than
    the two are not read. A very long text is searched as a whole, in one task; thresholds come from the
    tokens of all rows.
    """
    source = F.coalesce(F.col(text), F.lit(""))
    tokens = F.when(source.rlike(_LONG_RUN), _tested(_spans(source, _TOKEN))).otherwise(
        _none("start:int,end:int,stratum:int,p:double")
    )
    found = docs.select(F.col(doc_id).alias("_doc"), base_spans(source).alias("_base"), tokens.alias("_tokens"))
    found = kept(found, "secrets")
    each = found.where(F.size("_tokens") > 0).select(F.explode("_tokens").alias("t"))
    limits = false_share_thresholds(each.select("t.stratum", "t.p"), most_false)

    def apart(span: Column) -> Column:
        return ~F.exists("_base", lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))

    noise = F.filter("_tokens", lambda s: limits.accepts(s) & apart(s))
    spans = F.array_sort(F.concat("_base", _kind(len(KINDS), noise)))
    return found.select(F.col("_doc").alias(doc_id), spans.alias("spans"))


def span_list(spans: Column) -> Column:
    """Spans as text: ``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in (*KINDS, NOISE)])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def redact(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """The text with every maximal run of spans replaced by ``mask``."""
    whole = F.coalesce(text, F.lit(""))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def put(so_far: Column, span: Column) -> Column:
        fresh = span["start"] >= so_far["at"]
        between = F.substring(whole, so_far["at"] + 1, F.greatest(span["start"] - so_far["at"], F.lit(0)))
        return F.struct(
            F.greatest(so_far["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(so_far["done"], between, F.lit(mask))).otherwise(so_far["done"]).alias("done"),
        )

    rest = F.length(whole)
    return F.aggregate(
        spans, zero, put, lambda s: F.concat(s["done"], F.substring(whole, s["at"] + 1, rest))
    )

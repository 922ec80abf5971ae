"""Log text to transactions, as one pipeline of column expressions.

A line is first given a ``format_id`` from cheap text tests, then one CASE per
field picks the text of that field, and only the chosen text is converted. So
every conversion (timestamp, amount) is written and evaluated once, whatever
the number of formats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import (
    AMOUNT_PATTERN, CURRENCY_RATES_TO_GBP, DEVICES, LOCATIONS, MALFORMED_MARKER,
    REGION_CURRENCIES, TRANSACTION_TYPES, UNUSUAL_AMOUNT,
)
from ..functions.dates import parse_timestamp, single_spaced
from ..functions.numbers import rounded, total
from ..functions.text import (
    WORD, after, first_containing, has_pieces, none_to_null, strip, tokens,
)

# Names of the layouts, by format_id.
FORMAT_NAMES = {
    1: "pipe_standard", 2: "colon_separated", 3: "pipe_with_usr", 4: "arrow_format",
    5: "triple_colon", 6: "dash_format", 7: "space_separated", 8: "regex_fallback",
}
# What free text is searched for.
_TYPE = "(?i)(" + "|".join(TRANSACTION_TYPES) + ")"
_LOCATION = "(?i)(" + "|".join([*LOCATIONS, "None"]) + ")"
_DEVICE = "(?i)(" + "|".join([*DEVICES, "None"]) + ")"
_USER = r"(?i)(user\d+)"
_ISO_TIME = r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})"
_SLASH_TIME = r"(\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2})"
_PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

PARSED_COLUMNS = [
    "tx_id", "raw_log", "timestamp", "user_id", "transaction_type", "amount_raw", "amount",
    "currency", "location", "device", "is_parsed", "parse_errors", "format_id",
]


def log_class(raw: Column) -> Column:
    """``empty``, ``malformed`` or ``log``."""
    text = strip(raw)
    return (
        F.when(raw.isNull() | text.isin("", '""'), "empty")
        .when(text == MALFORMED_MARKER, "malformed")
        .otherwise("log")
    )


def format_id(line: Column) -> Column:
    """The first layout whose tests the (trimmed) line passes; 8 is free text."""
    return (
        F.when(line.contains("|") & line.contains("user:") & has_pieces(line, r"\|", 3), 1)
        .when(line.contains("::") & has_pieces(line, "::", 4), 2)
        .when(line.startswith("usr:") & has_pieces(line, r"\|", 4), 3)
        .when(line.contains(">>") & line.contains("["), 4)
        .when(line.contains("***") & has_pieces(line, ":::", 3), 5)
        .when(line.contains("user=") & line.contains("action=") & has_pieces(line, " - ", 3), 6)
        .when(line.startswith("user") & (F.size(tokens(line)) >= 4), 7)
        .otherwise(8)
    )


def _pieces(line: Column, fmt: Column) -> Column:
    """The line cut at the separator of its format."""
    return (
        F.when(fmt.isin(1, 3), F.split(line, r"\|"))
        .when(fmt == 2, F.split(line, "::"))
        .when(fmt == 4, F.split(line, ">>", 2))
        .when(fmt == 5, F.split(line, ":::"))
        .when(fmt == 6, F.split(line, " - "))
        .when(fmt == 7, tokens(line))
        .otherwise(F.array(line))
    )


def _pick(fmt: Column, **by_format: Column) -> Column:
    """CASE over the format: ``f2=expr`` applies to format 2."""
    out = None
    for name, expr in by_format.items():
        cond = fmt == int(name[1:])
        out = F.when(cond, expr) if out is None else out.when(cond, expr)
    return out


def _shared_texts(fmt: Column, p: Column) -> dict[str, Column]:
    """Pieces that several fields of one format read: written once, evaluated once."""
    at = lambda i: F.get(p, F.lit(i))
    return {
        "_body": _pick(fmt, f1=after(at(2), "txn:"), f4=at(1), f5=at(2)),
        "_actor": _pick(fmt, f1=after(at(1), "user:"), f5=at(1)),
        "_words": F.when(fmt == 6, tokens(F.ltrim(after(first_containing(p, "action="), "action=")))),
    }


# Formats whose field is searched by a pattern: there, an empty text means "not found".
_SEARCHED = {"user_id": (4, 5, 8), "transaction_type": (1, 4, 5, 6, 8), "location": (1, 4, 5, 8), "device": (4, 5, 8)}
# Formats whose field is trimmed and lower-cased.
_TRIMMED = {"user_id": (1,), "location": (4, 5, 6), "device": (1, 4, 5)}
_LOWERED = {"transaction_type": (1, 5, 8)}


def _field_texts(fmt: Column, line: Column, p: Column, compat: bool) -> dict[str, Column]:
    """The text of each field, picked by format; every pattern is applied once."""
    at = lambda i: F.get(p, F.lit(i))
    find = lambda text, pattern, group=1: F.regexp_extract(text, pattern, group)
    body, actor, words = F.col("_body"), F.col("_actor"), F.col("_words")
    kind = WORD if compat else r"[\p{L}\p{N}_-]+"
    place4 = r"- ([^/]+?)( //| dev:)" if compat else r"amt=\S+ - ([^/]+?)( //| dev:)"
    amount5 = r"amt:([£$€]?\d+\.?\d*)" if compat else r"amt:([£$€]?\d+\.?\d*[£$€]?)"
    rest = lambda a, start: F.array_join(F.slice(a, start, F.greatest(F.size(a) - (start - 1), F.lit(0))), " ")
    # Digits of dates, users and devices are no amounts; only the corrected mode removes them.
    free_amount = line if compat else F.regexp_replace(
        line, rf"{_ISO_TIME}|{_SLASH_TIME}|(?i:user\d+)|(?i:{'|'.join(DEVICES)})", " ")
    free_time = find(line, rf"{_ISO_TIME}", 1)
    return {
        "time_text": _pick(
            fmt, f1=at(0), f2=at(0), f3=at(4), f4=at(0), f5=at(0), f6=at(0),
            f7=F.concat_ws(" ", at(1), at(2)),
            f8=F.when(line.rlike(_ISO_TIME), free_time).otherwise(find(line, _SLASH_TIME))),
        "user_id": _pick(
            fmt, f1=actor, f2=at(1), f3=after(at(0), "usr:"), f4=find(body, r"\[([^\]]+)\]"),
            f5=find(actor, rf"({WORD}) \*\*\* {kind}"), f6=after(first_containing(p, "user="), "user="),
            f7=at(0), f8=find(line, _USER)),
        "transaction_type": _pick(
            fmt, f1=find(body, _TYPE), f2=at(2), f3=at(1), f4=find(body, f"did ({kind})"),
            f5=find(actor, rf"{WORD} \*\*\* ({kind})"), f6=F.get(words, F.lit(0)), f7=at(3), f8=find(line, _TYPE)),
        "amount_text": _pick(
            fmt, f1=body, f2=at(3), f3=at(2), f4=find(body, r"amt=([£$€]?\d+\.?\d*)"), f5=find(body, amount5),
            f6=rest(words, 2), f7=at(4), f8=free_amount),
        "location": _pick(
            fmt, f1=find(body, _LOCATION), f2=at(4), f3=at(3), f4=find(body, place4), f5=find(body, r"@ ([^<]+)"),
            f6=after(first_containing(p, "ATM:"), "ATM:"), f7=at(5), f8=find(line, _LOCATION)),
        "device": _pick(
            fmt, f1=after(at(3), "device:"), f2=at(5), f3=at(5), f4=find(body, r"dev:([^$]+)$"),
            f5=find(body, r"<([^>]+)>"), f6=after(first_containing(p, "device="), "device="),
            f7=at(6) if compat else rest(p, 7), f8=find(line, _DEVICE)),
    }


def _clean_field(name: str, fmt: Column) -> Column:
    """Not-found texts become null; then the format's own trimming and lower-casing."""
    c = F.col(f"_{name}")
    out = F.when(fmt.isin(*_SEARCHED[name]) & (c == ""), F.lit(None).cast("string"))
    if name in _TRIMMED:
        out = out.when(fmt.isin(*_TRIMMED[name]), strip(c))
    if name in _LOWERED:
        out = out.when(fmt.isin(*_LOWERED[name]), F.lower(c))
    return out.otherwise(c)


def gbp_amount(amount: Column, currency: Column) -> Column:
    """Amount in GBP at the fixed rates, to the penny; unknown currencies count as GBP."""
    rates = F.create_map(*[F.lit(x) for kv in CURRENCY_RATES_TO_GBP.items() for x in kv])
    return rounded(amount * F.coalesce(F.try_element_at(rates, currency), F.lit(1.0)), 2)


def clean_location(location: Column) -> Column:
    """Keep what follows the last dash."""
    return F.when(location.contains("-"), strip(F.substring_index(location, "-", -1))).otherwise(location)


def impute_currency(currency: Column, location: Column) -> Column:
    """A missing currency becomes pounds wherever a location is known."""
    missing = currency.isNull() | currency.isin("None", "")
    return F.when(missing & location.isNotNull(), "£").otherwise(currency)


def infer_region_currency(location: Column) -> Column:
    """Currency code by city name inside the location text; pounds by default."""
    place = F.lower(F.coalesce(location, F.lit("")))
    out = None
    for code, cities in REGION_CURRENCIES.items():
        cond = place.rlike("|".join(cities))
        out = F.when(cond, code) if out is None else out.when(cond, code)
    return out.otherwise("GBP")


def parse_lines(df: DataFrame, column: str = "raw_log", compat: bool = True) -> DataFrame:
    """Add the parsed fields to every row, before any clean-up of the whole table.

    Rows that are empty or malformed get null fields and ``is_parsed`` false.
    """
    keep = [c for c in df.columns if c not in ("raw_log", column)]
    staged = (
        df.withColumn("log_class", log_class(F.col(column)))
        .withColumn("raw_log", strip(F.col(column)))
        .withColumn("format_id", F.when(F.col("log_class") == "log", format_id(F.col("raw_log"))))
        .withColumn("_p", _pieces(F.col("raw_log"), F.col("format_id")))
    )
    fmt, text = F.col("format_id"), F.col("_amount_text")
    staged = staged.withColumns(_shared_texts(fmt, F.col("_p")))
    fields = _field_texts(fmt, F.col("raw_log"), F.col("_p"), compat)
    staged = staged.withColumns({f"_{k}": v for k, v in fields.items()})
    number = (
        F.when(fmt == 7, F.when(text.rlike(_PLAIN_NUMBER), text.try_cast("double")))
        .otherwise(F.regexp_extract(text, AMOUNT_PATTERN, 2).try_cast("double"))
    )
    symbol = F.when(fmt != 7, F.regexp_extract(text, AMOUNT_PATTERN, 1))
    if not compat:
        symbol = F.when(fmt == 5, F.regexp_extract(text, r"([£$€])", 1)).otherwise(symbol)
    staged = staged.withColumns({
        "_time_text": single_spaced(strip(F.col("_time_text"))), "_number": number, "_symbol": symbol,
        **{f"_{k}": _clean_field(k, fmt) for k in _SEARCHED},
    }).withColumn("_timestamp", parse_timestamp(F.col("_time_text")))
    free = fmt == 8
    ts, num, sym = F.col("_timestamp"), F.col("_number"), F.nullif(F.col("_symbol"), F.lit(""))
    user, kind = F.col("_user_id"), F.col("_transaction_type")
    loc = none_to_null(F.col("_location"))
    # The pipe layout keeps the device text "None" as it is.
    dev = F.when(fmt == 1, F.col("_device")).otherwise(none_to_null(F.col("_device"))) if compat else (
        none_to_null(F.col("_device")))
    found = (
        ts.isNotNull() | user.isNotNull() | kind.isNotNull()
        | F.coalesce(num != 0, F.lit(False)) | loc.isNotNull() | dev.isNotNull()
    )
    fallback_currency = F.when(num.isNotNull(), "GBP").otherwise(sym) if compat else F.coalesce(
        sym, F.when(num.isNotNull(), "unknown"))
    errors = F.array_compact(F.array(
        F.when(fmt.isNull(), "Empty or malformed log"),
        F.when(free & (num < 0), "Negative amount"),
        F.when(free & (num > UNUSUAL_AMOUNT), "Unusually large amount")))
    record = F.struct(
        fmt.alias("format_id"),
        ts.alias("timestamp"),
        F.when(free & ~user.startswith("user"), F.concat(F.lit("user"), user)).otherwise(user).alias("user_id"),
        kind.alias("transaction_type"),
        F.when(free, F.abs(num)).otherwise(num).alias("amount"),
        F.when(free, fallback_currency).otherwise(sym).alias("currency"),
        loc.alias("location"),
        dev.alias("device"),
        F.when(fmt.isNull(), False).when(free, found).otherwise(True).alias("is_parsed"),
        F.nullif(F.concat_ws("; ", errors), F.lit("")).alias("parse_errors"),
    )
    # One record per line, exploded from a one-element array: a filter on a parsed
    # field then stays above this step instead of repeating the parse inside itself.
    return staged.select(*keep, "raw_log", "log_class", F.inline(F.array(record)))


def standardise(parsed: DataFrame) -> DataFrame:
    """Clean-up of the whole table: location suffix, missing currency, GBP amounts."""
    return (
        parsed.withColumn("location", clean_location(F.col("location")))
        .withColumn("currency", impute_currency(F.col("currency"), F.col("location")))
        .withColumn("amount_raw", F.col("amount"))
        .withColumn("amount", gbp_amount(F.col("amount"), F.col("currency")))
    )


def parse_logs(df: DataFrame, column: str = "raw_log", id_column: str = "tx_id", compat: bool = True) -> DataFrame:
    """Raw log lines to the parsed table; empty and malformed lines are left out."""
    lines = df.select(F.col(id_column).alias("tx_id"), F.col(column).alias("raw_log"))
    kept = lines.filter(log_class(F.col("raw_log")) == "log")
    return standardise(parse_lines(kept, compat=compat)).select(*PARSED_COLUMNS)


def valid_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("is_parsed"))


def sample_valid_lines(df: DataFrame, column: str = "raw_log", n: int = 10, order: str = "tx_id") -> DataFrame:
    """The first ``n`` lines, in ``order``, that are neither empty nor malformed."""
    return df.filter(log_class(F.col(column)) == "log").orderBy(order).limit(n)


def currency_conversion_stats(parsed: DataFrame, currency: str = "currency", amount: str = "amount") -> DataFrame:
    """Per original currency: transactions, transactions with an amount, total amount."""
    return (
        parsed.groupBy(F.coalesce(F.col(currency), F.lit("none")).alias("original_currency"))
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            F.count(amount).alias("transactions_with_amount"),
            total(F.col(amount)).alias("total_amount"),
        )
    )

"""Exchange payloads (JSON text) to typed rows. Works on batch and streaming text alike.

Nothing in a payload stops a job: what cannot be read is set apart with its text and the reason
(:func:`rejects`), and the parsers give the other rows. A payload is rejected as a whole if it is empty,
not JSON of the layout, or has no list; an entry if a field that it needs is missing or unreadable.
An empty list is a payload without rows. Numbers that are not finite count as unreadable.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom import schema as S

# Payload layouts. Bar rows are [time ms, open, high, low, close, volume, turnover].
BAR_PAYLOAD = "result struct<list: array<array<string>>>"
OPEN_INTEREST_PAYLOAD = "result struct<list: array<struct<openInterest: string, timestamp: string>>>"
LONG_RATIO_PAYLOAD = "result struct<list: array<struct<buyRatio: string, timestamp: string>>>"
BALANCE_PAYLOAD = "time bigint, result struct<list: array<struct<totalWalletBalance: string>>>"
POSITION_PAYLOAD = (
    "info struct<createdTime: string, side: string, size: string, avgPrice: string, symbol: string>"
)
ORDER_PAYLOAD = "info struct<createdTime: string, side: string, price: string, symbol: string>"

#: Stored in place of a balance when the wallet could not be read (a fixed value).
BALANCE_ERROR = -99999.0

#: Milliseconds that a timestamp of the years 1 to 9999 can have.
_EARLIEST, _LATEST = -62_135_596_800_000, 253_402_300_799_999

Reader = Callable[[Column], Column]


def _number(value: Column) -> Column:
    read = value.try_cast("double")
    return F.when(~F.isnan(read) & (F.abs(read) != float("inf")), read)


def _time(value: Column) -> Column:
    millis = value.try_cast("bigint")
    return F.when(millis.between(_EARLIEST, _LATEST), F.timestamp_millis(millis))


def _text(value: Column) -> Column:
    return value


@dataclass(frozen=True)
class Payload:
    """How one kind of payload is read.

    ``entries`` gives the array of entries from the parsed payload. ``fields`` are the output columns:
    where an entry holds a value, and how it is read. ``optional`` ones may be missing or empty; a
    value that is there must be readable.
    """

    layout: str
    entries: Callable[[Column], Column]
    fields: dict[str, tuple[Reader, Reader]]
    optional: tuple[str, ...] = ()


def _listed(parsed: Column) -> Column:
    return parsed["result"]["list"]


def _own(parsed: Column) -> Column:
    """A payload that is one entry itself."""
    return F.when(parsed["info"].isNotNull(), F.array(parsed["info"]))


def _at(place: int) -> Reader:
    return lambda entry: F.get(entry, F.lit(place))


def _in(name: str) -> Reader:
    return lambda entry: entry[name]


PAYLOADS = {
    "bars": Payload(
        BAR_PAYLOAD,
        _listed,
        {S.TS: (_at(0), _time)} | {c: (_at(k), _number) for k, c in enumerate(S.OHLCV, start=1)},
    ),
    "open_interest": Payload(
        OPEN_INTEREST_PAYLOAD,
        _listed,
        {S.TS: (_in("timestamp"), _time), "open_interest": (_in("openInterest"), _number)},
    ),
    "long_ratio": Payload(
        LONG_RATIO_PAYLOAD,
        _listed,
        {S.TS: (_in("timestamp"), _time), "lsr": (_in("buyRatio"), _number)},
    ),
    "balance": Payload(
        BALANCE_PAYLOAD,
        lambda p: F.array(F.struct(p["time"].alias("time"), F.get(_listed(p), F.lit(0)).alias("wallet"))),
        {
            S.TS: (_in("time"), _time),
            "balance": (lambda e: e["wallet"]["totalWalletBalance"], _number),
        },
        optional=("balance",),
    ),
    "positions": Payload(
        POSITION_PAYLOAD,
        _own,
        {
            S.TS: (_in("createdTime"), _time),
            "side": (_in("side"), _text),
            "size": (_in("size"), _number),
            "avg_price": (_in("avgPrice"), _number),
            S.SYMBOL: (_in("symbol"), _text),
        },
        optional=("side", "avg_price"),
    ),
    "open_orders": Payload(
        ORDER_PAYLOAD,
        _own,
        {
            S.TS: (_in("createdTime"), _time),
            "side": (_in("side"), _text),
            "price": (_in("price"), _number),
            S.SYMBOL: (_in("symbol"), _text),
        },
    ),
}


def judged(payloads: DataFrame, kind: str, text: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``keep``, the kind's columns, and ``raw`` and ``reason``: one row per entry or rejected payload.

    Good entries have no ``reason``; rejected ones have no values but those that could be read.
    """
    p = PAYLOADS[kind]
    parsed = F.from_json(F.col(text), f"{p.layout}, __corrupt string", {"columnNameOfCorruptRecord": "__corrupt"})
    rows = payloads.select(*keep, F.col(text).alias("__raw"), parsed.alias("__p"))
    entries = p.entries(F.col("__p"))
    problem = (
        F.when(F.coalesce(F.trim("__raw"), F.lit("")) == "", "empty")
        .when(F.col("__p").isNull() | F.col("__p.__corrupt").isNotNull(), "not of the layout")
        .when(entries.isNull(), "no entries")
    )
    one = F.transform(F.when(problem.isNull(), entries), lambda e: F.struct(e.alias("e"), F.lit(None).cast("string").alias("problem")))
    none = F.transform(F.array(problem), lambda x: F.struct(F.get(entries, F.lit(0)).alias("e"), x.alias("problem")))
    rows = rows.withColumn("__entry", F.explode(F.when(problem.isNull(), one).otherwise(none)))
    values, faults = {}, []
    for name, (find, read) in p.fields.items():
        held = find(F.col("__entry.e"))
        values[name] = F.when(F.col("__entry.problem").isNull(), read(held))
        missing = F.coalesce(F.trim(held.cast("string")), F.lit("")) == ""
        bad = ~missing & read(held).isNull() if name in p.optional else missing | read(held).isNull()
        faults.append(F.when(bad, F.lit(f"bad {name}")))
    reason = F.coalesce("__entry.problem", *faults)
    return rows.select(
        *keep, *[v.alias(n) for n, v in values.items()], F.col("__raw").alias("raw"), reason.alias("reason")
    )


def accepted(rows: DataFrame, kind: str, keep: Sequence[str] = ()) -> DataFrame:
    """The good rows of :func:`judged`."""
    return rows.where("reason IS NULL").select(*keep, *PAYLOADS[kind].fields)


def rejects(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The dead letters of :func:`judged`: ``keep, raw, reason``, one row per payload and reason."""
    return rows.where("reason IS NOT NULL").select(*keep, "raw", "reason")


def _parsed(payloads: DataFrame, kind: str, text: str, keep: Sequence[str]) -> DataFrame:
    return accepted(judged(payloads, kind, text, keep), kind, keep)


def parse_bars(payloads: DataFrame, text: str = "value", keep: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """One row per bar; the turnover field is ignored."""
    return _parsed(payloads, "bars", text, keep)


def parse_open_interest(
    payloads: DataFrame, text: str = "value", keep: tuple[str, ...] = ("symbol",)
) -> DataFrame:
    return _parsed(payloads, "open_interest", text, keep)


def parse_long_ratio(
    payloads: DataFrame, text: str = "value", keep: tuple[str, ...] = ("symbol",)
) -> DataFrame:
    return _parsed(payloads, "long_ratio", text, keep)


def parse_balance(payloads: DataFrame, text: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Balance at the payload's time; the stored error value becomes NULL plus a flag."""
    rows = _parsed(payloads, "balance", text, keep)
    failed = F.col("balance").isNull() | (F.col("balance") == BALANCE_ERROR)
    return rows.select(
        *keep, S.TS, F.when(~failed, F.col("balance")).alias("balance"), failed.alias("is_error")
    )


def parse_positions(payloads: DataFrame, text: str = "value") -> DataFrame:
    return _parsed(payloads, "positions", text, ())


def parse_open_orders(payloads: DataFrame, model_source: str, text: str = "value") -> DataFrame:
    return _parsed(payloads, "open_orders", text, ()).withColumn("model_source", F.lit(model_source))

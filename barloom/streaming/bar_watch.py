"""Keyed state over a stream of bars: splices and stale tickers, with timers and expiry; and the same events of a table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: A move to this multiple of the last close or more, or to its inverse or less, is a splice.
SPLICE = 1.8
#: Days without a bar after which a ticker is stale, and after which it is forgotten.
STALE, FORGOTTEN = 10, 60
EVENTS = "ticker long, date date, event string, last_date date, last_close double, close double"
#: What the state store must be for timers and several states of a key.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
_DAY, _EPOCH = 86_400_000, dt.date(1970, 1, 1)


class BarWatch(StatefulProcessor):
    """Per ticker: bars that the watermark has not reached, and the last one that it has.

    Bars wait until the watermark reaches their date, so they are taken in order of their dates whatever files they came in. A timer for each waiting
    date, one for the day a ticker becomes stale and one for the day it is forgotten make the state move without new bars."""

    def __init__(self, splice: float, stale: int, forgotten: int):
        self.splice, self.stale, self.forgotten = splice, stale, forgotten

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "day long, close double, told boolean")
        self.waiting = handle.getMapState("waiting", "day long", "close double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        reached, late = timerValues.getCurrentWatermarkInMs() // _DAY, []
        for part in rows:
            best = part.assign(day=part["ts"].astype("int64") // (_DAY * _unit(part["ts"]))).groupby("day")["close"].max()
            for day, close in best.items():
                if day <= reached:  # days up to the watermark are settled
                    late.append((key[0], int(day), "late", None, None, float(close)))
                    continue
                here = (int(day),)
                before = self.waiting.getValue(here)[0] if self.waiting.containsKey(here) else None
                if before is None:
                    self.handle.registerTimer(int(day) * _DAY)
                if before is None or close > before:
                    self.waiting.updateValue(here, (float(close),))
        yield _events(late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        reached = timerValues.getCurrentWatermarkInMs() // _DAY
        out = []
        last = self.last.get() if self.last.exists() else None
        for day in sorted(k[0] for k in list(self.waiting.keys()) if k[0] <= reached):
            close = self.waiting.getValue((day,))[0]
            self.waiting.removeKey((day,))
            if last is not None:
                last = self._idle(key, last, day - 1, out)
            if last is not None and (close >= self.splice * last[1] or close * self.splice <= last[1]):
                out.append((key[0], day, "splice", last[0], last[1], close))
            last = (day, close, False)
            self.handle.registerTimer((day + self.stale) * _DAY)
            self.handle.registerTimer((day + self.forgotten) * _DAY)
        if last is not None:
            last = self._idle(key, last, reached, out)
        if last is None:
            self.last.clear()
        else:
            self.last.update(last)
        yield _events(out)

    def _idle(self, key, last, until: int, out: list):  # noqa: ANN001, ANN202
        """The last bar after days without another, up to `until`: told of once as stale, then forgotten."""
        day, close, told = last
        if not told and until >= day + self.stale:
            out.append((key[0], day + self.stale, "stale", day, close, None))
            told = True
        return None if until >= day + self.forgotten else (day, close, told)

    def close(self) -> None:
        pass


def _unit(ts: pd.Series) -> int:
    """Ticks of a column of timestamps in a millisecond."""
    return {"ns": 1_000_000, "us": 1_000, "ms": 1}[getattr(ts.dtype, "unit", "ns")]


def _events(rows: list[tuple]) -> pd.DataFrame:
    df = pd.DataFrame(rows, columns=["ticker", "date", "event", "last_date", "last_close", "close"])
    for c in ("date", "last_date"):
        df[c] = pd.Series([None if pd.isna(x) else _EPOCH + dt.timedelta(int(x)) for x in df[c]], dtype="object")
    return df.astype({"last_close": "float64", "close": "float64"})


def watched(bars: DataFrame, delay: str = "5 days", splice: float = SPLICE, stale: int = STALE, forgotten: int = FORGOTTEN) -> DataFrame:
    """Events of a stream of bars (ticker, date, close), appended once the watermark, the newest date less the delay, has reached them.

    Of bars with one ticker and date the greatest close counts; bars without ticker, date or close are left out; bars that come after the watermark has
    passed them change nothing: they are told of as events `late`, or dropped and counted in the query's progress where Spark has seen so first. The session needs the state store that STORE names."""
    rows = bars.where("ticker is not null and date is not null and close is not null").select(F.col("ticker").cast("long").alias("ticker"), F.col("date").cast("timestamp").alias("ts"), F.col("close").cast("double").alias("close"))
    return rows.withWatermark("ts", delay).groupBy("ticker").transformWithStateInPandas(BarWatch(splice, stale, forgotten), outputStructType=EVENTS, outputMode="Append", timeMode="eventTime")


def events(bars: DataFrame, until: str, splice: float = SPLICE, stale: int = STALE, forgotten: int = FORGOTTEN) -> DataFrame:
    """The events of a table of bars up to the date `until`: what `watched` has given once its watermark is there."""
    end = F.lit(until).cast("date")
    b = bars.where(F.col("close").isNotNull() & F.col("ticker").isNotNull() & (F.col("date") <= end)).groupBy(F.col("ticker").cast("long").alias("ticker"), "date").agg(F.max(F.col("close").cast("double")).alias("close"))
    by = Window.partitionBy("ticker").orderBy("date")
    b = b.withColumns({"last_date": F.lag("date").over(by), "last_close": F.lag("close").over(by), "next": F.lead("date").over(by)})
    jump = (F.col("close") >= splice * F.col("last_close")) | (F.col("close") * splice <= F.col("last_close"))
    spliced = b.where(jump & (F.datediff("date", "last_date") <= forgotten)).select("ticker", "date", F.lit("splice").alias("event"), "last_date", "last_close", "close")
    day = F.date_add("date", stale)
    idle = b.where(F.coalesce(F.col("next") > day, day <= end))
    return spliced.union(idle.select("ticker", day, F.lit("stale"), "date", "close", F.lit(None).cast("double")))

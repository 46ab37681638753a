"""Transaction ids of earlier loads: an index that is added to, not reread.

Each load stores its distinct ids once (``load_ids``, in folders by a hash of the id) and a Bloom filter of them
(``id_filters``): pages of 32,768 bits, an id's bits all in the page its hash names, so that an id meets one page. The
ids of a new load are first held against the OR of the earlier loads' pages. Only those that may have been seen, the
true repeats and a few false alarms, are looked up in the stored ids, in the folders they can be in. Pages have the
same number and layout in all loads, so they merge; a load that is run again replaces its own ids and pages only.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.operators.duplicates import ID, copies_per_id
from tallywatch.sources.tables import Tables

LOAD = "load_date"
IDS, FILTERS, CANDIDATES = "load_ids", "id_filters", "id_candidates"
PAGE_BITS = 32_768


@dataclass(frozen=True)
class IdIndex:
    """``pages`` bounds the filter: at 12 bits an id and more, about one unseen id in 300 is looked up for nothing. It
    must stay the same for all loads of a table."""

    pages: int = 16_384
    hashes: int = 6
    folders: int = 64


def _hashed(ids: DataFrame, index: IdIndex) -> DataFrame:
    h = f"xxhash64({ID})"
    return ids.selectExpr("*", f"pmod({h}, {index.pages}L) AS page", f"pmod({h}, {index.folders}L) AS folder")


def _bits(index: IdIndex) -> str:
    """The places of an id's bits in its page."""
    return f"transform(sequence(1, {index.hashes}), i -> pmod(xxhash64({ID}, i), {PAGE_BITS}L))"


def record(tables: Tables, load: DataFrame, date: dt.date, index: IdIndex = IdIndex()) -> DataFrame:
    """Store a load's ids and filter; returns its ids with their copies."""
    spread = _hashed(copies_per_id(load), index).repartitionByRange("folder", ID)
    ids = tables.write(spread.select(ID, "copies", "folder"), IDS, LOAD, date, by=("folder",))
    bits = _hashed(ids.select(ID), index).selectExpr("page", f"explode({_bits(index)}) AS bit")
    tables.write(bits.groupBy("page").agg(F.expr("bitmap_construct_agg(bit) AS bits")), FILTERS, LOAD, date)
    return ids.select(ID, "copies")


def seen_before(tables: Tables, ids: DataFrame, date: dt.date, index: IdIndex = IdIndex()) -> DataFrame:
    """Those of a load's ids (with their copies) that an earlier load holds."""
    earlier = [d for d in tables.days(IDS, LOAD) if d < date]
    if not earlier:
        return ids.where("false")
    before = f"{LOAD} < DATE'{date.isoformat()}'"
    pages = tables.read(FILTERS).where(before).groupBy("page").agg(F.expr("bitmap_or_agg(bits) AS bits"))
    is_set = "shiftright(CAST(conv(hex(substring(bits, CAST(p div 8 AS INT) + 1, 1)), 16, 10) AS INT), CAST(p % 8 AS INT)) & 1 = 1"
    likely = _hashed(ids, index).join(pages, "page").where(f"forall({_bits(index)}, p -> {is_set})").select(ID, "copies", "folder")
    # Written: their real number decides whether they go to the stored ids or those move to meet them.
    likely = tables.write(likely, CANDIDATES, LOAD, date)
    stored = tables.read(IDS).where(before).selectExpr(ID, "CAST(folder AS BIGINT) AS folder")
    return likely.join(stored, [ID, "folder"], "left_semi").select(ID, "copies")

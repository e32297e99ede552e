"""Surrogate keys that stay: a table of known keys grows by the tuples that each load adds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.operators.order import dense_key
from churnkit.sinks.ledger import Ledger, numbered


def stable_keys(rows: DataFrame, key: str, attributes: Sequence[str], root: str, load: int) -> DataFrame:
    """All known tuples of ``attributes`` with their keys, after the distinct tuples of ``rows`` were added.

    Tuples that an earlier load brought keep their keys; new ones are numbered from the highest key on, without gaps, in the order of
    the attributes, nulls first. Nulls are equal to nulls. Only new tuples are numbered and written. Loads come in
    rising order; the last one may be repeated, which replaces what it added.
    """
    ledger = Ledger(rows.sparkSession, root)
    known_loads = ledger.commits()
    later = [e for e in known_loads if e > numbered(load)]
    if later:
        raise ValueError(f"load {load} comes after load {int(max(later))}, whose keys follow on it")
    new = rows.select(*attributes).distinct()
    known = ledger.read(e for e in known_loads if e < numbered(load))
    highest = 0
    if known is not None:
        highest = known.agg(F.max(key)).first()[0] or 0
        same = reduce(lambda x, y: x & y, [F.col(f"new.{a}").eqNullSafe(F.col(f"known.{a}")) for a in attributes])
        new = new.alias("new").join(known.select(*attributes).alias("known"), same, "left_anti")
    ledger.commit(dense_key(new, key, attributes, distinct=True, start=highest + 1), numbered(load))
    return ledger.read()

"""Lab results: request, set, item and value joined on their ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def lab_results(req: DataFrame, sets: DataFrame, items: DataFrame, values: DataFrame | None = None, *,
                hist: str = "match", where: Column | None = None) -> DataFrame:
    """One row per result, joined from the request down: only requests have dates to be cut by.

    ``hist`` says how the history id takes part: ``match`` joins on it, ``zero`` keeps only
    current rows (the item level is not tested), ``ignore`` leaves it out. ``where`` is
    applied to the joined rows; Catalyst moves its parts to the levels they belong to.
    """
    if hist not in ("match", "zero", "ignore"):
        raise ValueError(f"hist must be 'match', 'zero' or 'ignore', not {hist!r}")
    if hist == "zero":
        req, sets = req.where("lab_hist_req_id = 0"), sets.where("lab_hist_req_id = 0")
        values = None if values is None else values.where("lab_hist_req_id = 0")
    extra = ["lab_hist_req_id"] if hist == "match" else []
    if not extra:
        req, sets, items = (d.drop("lab_hist_req_id") for d in (req, sets, items))
        values = None if values is None else values.drop("lab_hist_req_id")
    out = req.join(sets, ["lab_result_req_id", *extra]).join(items, ["lab_result_set_id", *extra])
    if values is not None:
        out = out.join(values, ["lab_result_item_id", *extra])
    return out if where is None else out.where(where)

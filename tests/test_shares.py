"""Line shares by column against whole numbers, a line at a time."""

import random

import pandas as pd
import pytest

from tidemart.streaming import shares


def divided(lines, size):
    names = [*shares._NUMBERS, "place", "texts"]
    frame = pd.DataFrame([{n: 0 for n in names} | {"texts": "{}"} | line for line in lines])
    read = lambda columns: (frame.iloc[i : i + size][[*columns]].copy() for i in range(0, len(frame), size))
    out = pd.concat(shares._divided(read))
    return list(zip(out["order_id"], out["order_detail_id"], out["share"]))


def by_hand(lines):
    """Python's whole numbers, a line at a time."""
    weights, last, rest, out = {}, {}, {}, []
    for x in lines:
        o = x["order_id"]
        weights[o] = weights.get(o, 0) + x["sku_price"]
        last[o] = max(last.get(o, (x["place"], x["order_detail_id"])), (x["place"], x["order_detail_id"]))
    floor = lambda x: x["final_total_amount"] * x["sku_price"] // weights[x["order_id"]] if weights[x["order_id"]] else 0
    for x in lines:
        rest[x["order_id"]] = rest.get(x["order_id"], x["final_total_amount"]) - floor(x)
    for x in lines:
        share = floor(x)
        if (x["place"], x["order_detail_id"]) == last[x["order_id"]]:
            share += rest.pop(x["order_id"], 0)
        out.append((x["order_id"], x["order_detail_id"], share))
    return out


@pytest.mark.parametrize("size", [1, 7, 1000])
@pytest.mark.parametrize("least, most", [(0, 9999), (-500, 500), (0, 10**17)])
def test_shares_by_column_are_those_by_hand(size, least, most):
    rng = random.Random(least + size)
    totals = [rng.randint(-most, most) for _ in range(12)]
    lines = [
        dict(order_id=o, order_detail_id=rng.randint(0, 9), place=rng.randint(-3, 3), sku_price=rng.randint(least, most), final_total_amount=totals[o])
        for o in (rng.randint(0, 11) for _ in range(200))
    ]
    lines += [dict(x, sku_price=0) for x in lines[:5]]
    assert divided(lines, size) == by_hand(lines)

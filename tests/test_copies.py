"""Signals that list a day more than once: brute force against the operators."""

import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import Decimal

from signalwatch.operators import copies
from signalwatch.plans import features, star
from signalwatch.schemas import CATEGORY, STAGING


def test_copies_come_back_whole(spark, monkeypatch):
    monkeypatch.setattr(copies, "_BLOCK", 7)
    values = ["a"] + ["b"] * 2 + ["c"] * 3 + ["d"] * 50
    df = spark.createDataFrame([(v,) for v in values], "v string")
    few = copies.few_copies(df)
    assert Counter(r.v for r in few.collect()) == {"a": 1, "b": 2, "c": 3, "d": 3}
    for back in (copies.all_copies(few), copies.all_copies(copies.counted(df), spread=False)):
        assert back.columns == ["v"]
        assert Counter(r.v for r in back.collect()) == Counter(values)


def test_lags_over_repeated_signal_rows(spark):
    rng = random.Random(1)
    days = [dt.date(2024, 1, d) for d in range(1, 9)]
    listed = [(rng.choice(days), c, Decimal(rng.choice([5, 10, 10, 10, 20])).quantize(Decimal(1)))
              for c in "ab" for _ in range(60)]
    listed += [(days[3], "a", Decimal(10))] * 200
    trends = spark.createDataFrame(listed, STAGING["trends"])
    time = spark.createDataFrame([(d, i) for i, d in enumerate(days[1:], 1)],
                                 "full_date date, time_sk long")
    got = Counter(
        (r.time_sk, r[CATEGORY], r.search_volume, r.search_lead_1, r.search_lead_2)
        for r in star.dim_trend(trends, time).collect()
    )
    place, series = {d: i for i, d in enumerate(days[1:], 1)}, defaultdict(list)
    for day, category, volume in sorted(listed):
        if day in place:
            series[category].append((place[day], volume.quantize(Decimal("0.01"))))
    expected = Counter()
    for category, values in series.items():
        for i, (time_sk, volume) in enumerate(values):
            before = [values[i - k][1] if i >= k else None for k in (1, 2)]
            expected[time_sk, category, volume, *before] += 1
    assert got == expected


def test_standalone_features_over_repeated_periods(spark):
    rng = random.Random(2)
    sold = {(c, t): rng.randint(1, 9) for c in "ab" for t in range(1, 12) if rng.random() < .8}
    fact = spark.createDataFrame(
        [(t, ord(c), Decimal(1)) for (c, t), n in sold.items() for _ in range(n)],
        "time_sk long, product_sk long, price decimal(10,2)")
    product = spark.createDataFrame([(ord(c), c) for c in "ab"],
                                    f"product_sk long, {CATEGORY} string")
    listed = [(c, t, float(rng.choice([10, 20, 40]))) for c in "ab" for t in range(1, 12)
              for _ in range(rng.choice([0, 1, 1, 2, 5]))]
    trends = spark.createDataFrame(listed, f"{CATEGORY} string, time_sk long, search_volume double")
    codes = spark.createDataFrame([("a", 0), ("b", 1)], f"{CATEGORY} string, category_code int")
    got = Counter(
        (r[CATEGORY], r.time_sk, r.sales_volume, round(r.search_volume, 6),
         round(r.search_lead_1, 6), round(r.search_lead_2, 6), round(r.search_momentum, 6),
         r.lag_1, round(r.moving_avg_3, 6))
        for r in features.daily_features_standalone(fact, product, trends, codes).collect()
    )
    expected = Counter()
    for c in "ab":
        times = sorted(t for k, t in sold if k == c)
        rows = []
        for i, t in enumerate(times):
            recent = [sold[c, u] for u in times[max(0, i - 2):i + 1]]
            found = sorted(v for k, u, v in listed if (k, u) == (c, t)) or [None]
            rows += [(t, v, sum(recent) / len(recent)) for v in found]
        known = [v for _, v, _ in rows if v is not None]
        rows = [(t, sum(known) / len(known) if v is None else v, m) for t, v, m in rows]
        for i, (t, v, m) in enumerate(rows):
            lead1 = rows[i - 1][1] if i >= 1 else v
            lead2 = rows[i - 2][1] if i >= 2 else v
            momentum = v / rows[i - 1][1] - 1 if i else 0.0
            before = sold[c, rows[i - 1][0]] if i else 0
            expected[c, t, sold[c, t], round(v, 6), round(lead1, 6), round(lead2, 6),
                     round(momentum, 6) + 0.0, before, round(m, 6)] += 1
    assert got == expected

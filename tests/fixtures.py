"""Small domain tables and their plain-Python scores."""

from __future__ import annotations

import itertools
import math
import random
import statistics

from peakloom.schema import ANALYTE, FRAGMENT, LABEL, REP

COLUMNS = (f"{ANALYTE} string, {REP} string, {LABEL} string, {FRAGMENT} string, times array<double>, "
           "intens array<double>, mass_err array<double>, MinStartTime double, MaxEndTime double, "
           "Area double, LibraryIntensity double")
TIMES = [10.0, 10.1, 10.2, 10.3, 10.4]


def golden(spark):
    """The hand-computed run: three fragments, zone 10.1 to 10.3."""
    rows = [("a", "r", "light", "b3", TIMES, [0.0, 30.0, 10.0, 5.0, 0.0], [0.0, 12.0, 20.0, 15.0, 0.0],
             10.1, 10.3, 90.0, 1.0),
            ("a", "r", "light", "y5", TIMES, [5.0, 40.0, 100.0, 50.0, -2.0], [0.0, 1.0, 2.0, -3.0, 9.0],
             10.1, 10.3, 500.0, 8.0),
            ("a", "r", "light", "y6", TIMES, [float("nan"), 20.0, 50.0, 25.0, 0.0], [0.0, -1.0, 1.0, 1.0, 0.0],
             10.1, 10.3, 240.0, 4.0)]
    return spark.createDataFrame(rows, COLUMNS)


def random_traces(spark, analytes: dict[str, int], reps=("r1", "r2"), labels=("heavy", "light"), seed=7,
                  points=9):
    """Traces for analytes with the given numbers of fragments; values from a seeded generator."""
    rng = random.Random(seed)
    times = [round(10 + i * 0.1, 4) for i in range(points)]
    rows = []
    for analyte, n in analytes.items():
        for f in range(n):
            library = float(rng.randint(1, 60))
            for rep, label in itertools.product(reps, labels):
                centre, width = rng.choice([3.5, 4.0, 4.5, 6.0]), rng.choice([2.0, 2.5, 3.0])
                height = rng.uniform(50, 500)
                intens = [max(-3.0, height * (1 - ((i - centre) / width) ** 2)) for i in range(points)]
                errors = [rng.uniform(-12, 12) * (1 + f % 3) / 3 for _ in range(points)]
                rows.append((analyte, rep, label, f"f{f:02d}", times, intens, errors, 10.2, 10.6, height, library))
    return spark.createDataFrame(rows, COLUMNS)


def quantile(values, q):
    values = sorted(values)
    at = q * (len(values) - 1)
    low, high = math.floor(at), math.ceil(at)
    return values[low] + (values[high] - values[low]) * (at - low)


def cosine(xs, ys):
    xx, yy = sum(x * x for x in xs), sum(y * y for y in ys)
    return min(1.0, sum(x * y for x, y in zip(xs, ys)) / math.sqrt(xx * yy)) if xx * yy > 0 else None


def mean_fitness(cells, subset, library, profile):
    """Mean composite score over the runs of one analyte, straight from the definition.

    `cells`: {(rep, label): {fragment: row}} with x, Area, err_score.
    """
    total = 0.0
    for (_, label), run in cells.items():
        inside = [f for f in subset if f in run]
        if not inside:
            continue
        summed = [sum(run[f]["x"][i] for f in inside) for i in range(len(run[inside[0]]["x"]))]
        similarity = statistics.fmean(cosine(run[f]["x"], summed) or 0.0 for f in inside)
        areas = [run[f]["Area"] for f in inside]
        lib = cosine(areas, [library.get(f) or 0.0 for f in inside])
        shape = cosine(areas, [profile[label, f] for f in inside])
        error = statistics.fmean(run[f]["err_score"] for f in inside)
        if lib is not None and shape is not None:
            total += similarity ** 9.5 * lib ** 4.5 * error ** 2.5 * shape ** 0.5
    return total / len(cells)

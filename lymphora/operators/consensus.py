"""Consensus (AGG10-AGG12), affine alignment and its description (FN8, FN9), overlap merging (FN7) and ordered folds (MRG1-MRG5)."""

from __future__ import annotations

from collections import Counter
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def consensus(rows: list[str], threshold: float = 0.7, ambiguous: str = "N", keep_gaps: bool = False) -> str:
    """Column majority, read from the 3' end. In the last ten columns only rows that have begun count: their
    number is the largest so far of rows without a gap there, and a twentieth of all rows at least."""
    width = min(map(len, rows), default=0)
    if not width:
        return ""
    out, begun, n = [], int(0.05 * len(rows)), len(rows)
    for back, column in enumerate(zip(*(r[width - 1 :: -1] for r in (x[:width] for x in rows)))):
        counts = Counter(column)  # of equal counts the one seen first is taken
        begun = max(begun, n - counts["-"])
        counts["-"] -= n - begun
        c, most = counts.most_common(1)[0]
        if back >= 10:
            begun = n
        if most / begun < threshold:
            out.append(ambiguous)
        elif keep_gaps or c != "-":
            out.append(c)
    return "".join(reversed(out))


def align(a: str, b: str, gap_open: int = -6, gap_extend: int = -1, mismatch: int = -3, match: int = 1) -> tuple[int, str, str]:
    """Global alignment with affine gaps (Gotoh 1982): score and both rows. A gap of k costs gap_open + (k - 1) * gap_extend."""
    low = -(10**9)
    n, m = len(a), len(b)
    best = np.full((3, n + 1, m + 1), low, np.int64)  # 0 both letters, 1 gap in b, 2 gap in a
    best[0, 0, 0] = 0
    for i in range(1, n + 1):
        best[1, i, 0] = gap_open + (i - 1) * gap_extend
    for j in range(1, m + 1):
        best[2, 0, j] = gap_open + (j - 1) * gap_extend
    place, y_ = np.arange(m + 1) * gap_extend, np.frombuffer(b.encode("utf-32-le"), np.uint32)
    for i in range(1, n + 1):  # a row at a time; a gap in a is a running maximum along it
        best[0, i, 1:] = best[:, i - 1, :-1].max(axis=0) + np.where(y_ == ord(a[i - 1]), match, mismatch)
        best[1, i, 1:] = np.maximum(np.maximum(best[0, i - 1, 1:], best[2, i - 1, 1:]) + gap_open, best[1, i - 1, 1:] + gap_extend)
        before = np.maximum.accumulate(np.maximum(best[0, i], best[1, i])[:-1] - place[:-1])
        best[2, i, 1:] = before + place[:-1] + gap_open
    k = int(best[:, n, m].argmax())
    score, i, j, x, y = int(best[k, n, m]), n, m, [], []
    while i or j:
        di, dj = ((1, 1), (1, 0), (0, 1))[k]
        x.append(a[i - 1] if di else "-")
        y.append(b[j - 1] if dj else "-")
        now, i, j = best[k, i, j], i - di, j - dj
        if k == 0:
            k = int(best[:, i, j].argmax())
        else:
            k = next((p for p in range(3) if best[p, i, j] + (gap_extend if p == k else gap_open) == now), 0)
    return score, "".join(reversed(x)), "".join(reversed(y))


def changes(reference: str, query: str) -> str:
    """FN9: how query differs from reference, from their affine alignment: 3G>C, 3_4delTT, 2_3insTT."""
    _, x, y = align(reference, query)
    kind = lambda p: "same" if p[0] == p[1] else "ins" if p[0] == "-" else "del" if p[1] == "-" else "sub"
    out, at = [], 1
    for what, pairs in groupby(zip(x, y), kind):
        pairs = list(pairs)
        old, new = ("".join(side) for side in zip(*pairs))
        if what == "sub":
            out += [f"{at + k}{p}>{q}" for k, (p, q) in enumerate(pairs)]
        elif what == "ins":
            out.append(f"{at - 1}_{at}ins{new}")
            continue
        elif what == "del":
            out.append(f"{at}_{at + len(old) - 1}del{old}")
        at += len(pairs)
    return "; ".join(out)


def described(df: DataFrame, reference: str, query: str, name: str = "changes") -> DataFrame:
    """FN9 as a column: distinct pairs are aligned in Arrow batches."""
    @F.pandas_udf("string")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        known = {p: changes(*p) for p in set(zip(a, b)) if None not in p}
        return pd.Series([known.get(p) for p in zip(a, b)], dtype=object)

    return df.withColumn(name, run(F.col(reference), F.col(query)))


def aligned(rows: list[str]) -> list[str]:
    """AGG12: a multiple alignment around the most frequent row (a centre star): each distinct row is aligned with it,
    unless it has its length and mostly its letters, and the gaps that any needs are opened in all."""
    counts = Counter(rows)
    centre = counts.most_common(1)[0][0]
    pairs = {}
    for r in counts:
        same = len(r) == len(centre) and sum(p != q for p, q in zip(r, centre)) <= 0.2 * len(r)
        pairs[r] = (centre, r) if same else align(centre, r)[1:]
    room = [0] * (len(centre) + 1)  # letters before each of the centre's, at most
    for x, _ in pairs.values():
        at = run = 0
        for c in x + "$":
            if c == "-":
                run += 1
                continue
            room[at] = max(room[at], run)
            at, run = at + 1, 0
    wide = {}
    for r, (x, y) in pairs.items():
        out, at, run = [], 0, []
        for c, q in zip(x + "$", y + "$"):
            if c == "-":
                run.append(q)
                continue
            out += run + ["-"] * (room[at] - len(run)) + ([q] if c != "$" else [])
            at, run = at + 1, []
        wide[r] = "".join(out)
    return [wide[r] for r in rows]


def iterative_consensus(rows: list[str], threshold: float = 0.6, start: int = 200, most: int = 1600) -> str:
    """AGG11: the consensus of the first start rows; while it holds an N, of twice as many, up to most. Rows come in the
    order of a seeded hash, so the first ones are a sample."""
    n = start
    while True:
        found = consensus(aligned(rows[:n]), threshold).strip("N") if rows else ""
        if "N" not in found or n >= len(rows) or 2 * n > most:
            return found
        n *= 2


def overlap(a: str, b: str) -> int:
    """Length of the longest suffix of a that is a prefix of b."""
    return next((k for k in range(min(len(a), len(b)), 0, -1) if a.endswith(b[:k])), 0)


def merge_overlapping(a: str, b: str, share: float = 0.5) -> str | None:
    """FN7: the string that holds both if one holds the other or they overlap by share of the shorter, else None."""
    for x, y in ((a, b), (b, a)):
        if y in x:
            return x
    for x, y in ((a, b), (b, a)):
        k = overlap(x, y)
        if k and k >= share * min(len(a), len(b)):
            return x + y[k:]
    return None


def fold(items: list, merge) -> list:
    """Adds items in order; merge(kept, new) gives what replaces both, or None if both stay."""
    kept: list = []
    for new in items:
        stay = []
        for old in kept:
            both = merge(old, new)
            if both is None:
                stay.append(old)
            else:
                new = both
        kept = [*stay, new]
    return kept


def sibling_sequence(a: str, b: str) -> str | None:
    """MRG1: equal up to the shorter's end with N as any base; the longer, with the other's bases for its Ns."""
    if any(x != y and "N" not in (x, y) for x, y in zip(a, b)):
        return None
    both = "".join(y if x == "N" else x for x, y in zip(a, b))
    return both + (a if len(a) > len(b) else b)[len(both) :]


def prefix_sequence(old: str, new: str) -> str | None:
    """MRG2: the existing item if one is the other's prefix."""
    return old if old.startswith(new) or new.startswith(old) else None


def letter_named(names: list[str]) -> list[str]:
    """MRG5: repeated names get A, B and so on, the first that is free."""
    seen: set[str] = set()
    out = []
    for name in names:
        new = next((n for n in [name, *(name + chr(65 + k) for k in range(26))] if n not in seen), None)
        if new is None:
            raise ValueError(f"too many rows are called {name}")
        seen.add(new)
        out.append(new)
    return out


def folded(df: DataFrame, keys: list[str], order: str, schema: str, merge) -> DataFrame:
    """An ordered fold of each group's rows as a grouped-map operator. merge(kept, new) takes and gives dicts of a row's
    columns, or None if both stay. For groups as small as a gene's candidates."""
    columns = [c for c in df.columns if c not in keys]

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = fold(pdf.sort_values(order)[columns].to_dict("records"), merge)
        return pd.DataFrame([dict(zip(keys, key)) | r for r in rows], columns=[*keys, *columns], dtype=object)

    return df.groupBy(*keys).applyInPandas(run, schema)


def siblings(kept: dict, new: dict) -> dict | None:
    """MRG1 of rows (sequence, name, requested): names are joined, requested if either is."""
    both = sibling_sequence(kept["sequence"], new["sequence"])
    return None if both is None else kept | {"sequence": both, "name": f"{kept['name']};{new['name']}", "requested": kept["requested"] or new["requested"]}


def prefixes(kept: dict, new: dict) -> dict | None:
    """MRG2, SET1 of rows (sequence, name)."""
    return kept if prefix_sequence(kept["sequence"], new["sequence"]) is not None else None


def overlapping(kept: dict, new: dict) -> dict | None:
    """MRG3 of rows (sequence, name, max_count): counts are summed."""
    both = merge_overlapping(kept["sequence"], new["sequence"])
    return None if both is None else kept | {"sequence": both, "max_count": kept["max_count"] + new["max_count"]}


def bounded_distance(a: str, b: str, most: int) -> int:
    """Edit distance, most + 1 beyond most; only the band that can matter is filled."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        low, high = max(1, i - most), min(len(b), i + most)
        new = [most + 1] * (len(b) + 1)
        new[0] = i if i <= most else most + 1
        for j in range(low, high + 1):
            new[j] = min(row[j - 1] + (x != b[j - 1]), row[j] + 1, new[j - 1] + 1)
        row = new
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


def allele_ratio(ratio: float | None, cross_mapping: float | None):
    """MRG4 of rows (name, sequence, unique_CDR3, exact_occ): of two alleles of a gene, the one with under ratio of the other's
    CDR3s goes; else of two sequences within one edit at their common end, the one with under cross_mapping of both's occurrences."""
    def same(a: str, b: str) -> bool:
        return "*" in a and "*" in b and a.split("*")[0] == b.split("*")[0]

    def merge(kept: dict, new: dict) -> dict | None:
        if ratio and same(kept["name"], new["name"]):
            for low, high in ((kept, new), (new, kept)):
                if high["unique_CDR3"] and low["unique_CDR3"] / high["unique_CDR3"] < ratio:
                    return high
        if cross_mapping:
            short, long = sorted((kept, new), key=lambda r: len(r["sequence"])) if len(new["sequence"]) < len(kept["sequence"]) else (kept, new)
            if bounded_distance(short["sequence"], long["sequence"][len(long["sequence"]) - len(short["sequence"]) :], 1) > 1:
                return None
            total = short["exact_occ"] + long["exact_occ"]
            for low, high in ((short, long), (long, short)):
                if total and low["exact_occ"] / total < cross_mapping:
                    return high
        return None

    return merge

"""CDR3 detection in translated sequences (FN4-FN6)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sequence import CODONS, nt_to_aa

#: Motifs around the CDR3 by locus (before, CDR3, after), the second choice for heavy chains,
#: ends of V and starts of J regions. Letters before a CDR3: as many as FRONT says.
WHOLE = {
    "IGH": "[FY][FHVWY]C([ADEGIKMNRSTV].{3,31})W[GAV]",
    "IGK": "[FSVY][CFHNVY][CDFGLSW](.{4,15})[FLV][GRV]",
    "IGL": "[CDY](?![CDY][CFHSY][CFGW])[CFHSY][CFGW](.{4,15})[FS]G",
}
OTHER_HEAVY = "C(.[RK].{3,30})[WF]G.G"
FRONT, OTHER_FRONT = 3, 1
V_END_HEAVY, OTHER_V_END_HEAVY = "[FY][FHVWY]C([ADEGIKMNRSTV*]|$)", "C(.[RK])"
V_END = {"IGK": "[FSVY][CFHNVY][CDFGLSW]", "IGL": "[CDY](?![CDY][CFHSY][CFGW])[CFHSY][CFGW]", "TRG": "[YFH]C", "TRD": "[YFH]C"}
J_START = {"IGH": "W[GAV]", "IGK": "FG", "IGL": "FG", "TRA": "FG", "TRB": "FG", "TRG": "FG", "TRD": "FG"}
TAIL, SHORT_TAIL = 15, 8


def in_codons(regex: str) -> str:
    """A regular expression over amino acids as one over bases: letters and classes become their codons, a dot any three bases."""
    def either(letters: str) -> str:
        by: dict[str, str] = {}
        for codon in sorted(c for c, a in CODONS.items() if a in letters):
            by[codon[:2]] = by.get(codon[:2], "") + codon[2]
        return f"(?:{'|'.join(f'{k}[{v}]' for k, v in by.items())})"

    part = lambda m: "(?:...)" if m[0] == "." else either(m[0]) if m[0].isupper() else either(m[0][1:-1]) if m[0][0] == "[" else m[0]
    return re.sub(r"\[[A-Z]+\]|[A-Z.]|\{[^}]*\}|\(\?!", part, regex)


def _any(regex: str) -> str:
    return f"(?s){in_codons(regex)}"


def _at(sequence: Column, regex: str, before: str) -> Column:
    """Struct (start, stop) in bases of the first group of regex, null without a match. Before the motif is what before matches, the
    least. Bases are searched for codons: to translate reads takes far longer than to find the few that matter."""
    front, behind = re.split(r"\((?!\?)", regex, maxsplit=1)
    whole = f"(?s)^({before}{in_codons(front)})({in_codons(behind)}"
    start = F.length(F.regexp_extract(sequence, whole, 1))  # 0 without a match
    return F.when(start > 0, F.struct(start.alias("start"), (start + F.length(F.regexp_extract(sequence, whole, 2))).alias("stop")))


def find_cdr3(sequence: Column, locus: str) -> Column:
    """FN4: struct (start, stop), 0-based, of the CDR3 in any frame, the least; null if there is none or the locus has no motif.

    The first match in any frame has the least start. For heavy chains it is the second motif's only if its frame lacks the
    first motif, so frames are looked at one by one where the second motif comes first, and in texts beyond ASCII."""
    if locus not in WHOLE:
        return F.lit(None).cast("struct<start:int,stop:int>")
    first = _any(WHOLE[locus])
    second = _any(OTHER_HEAVY) if locus == "IGH" else None
    found = F.struct(*(F.regexp_instr(sequence, F.lit(r)).alias(n) for n, r in (("p", first), ("q", second)) if r), (F.length(sequence) != F.octet_length(sequence)).alias("wide"))

    def placed(x: Column) -> Column:
        at = lambda place, front, r: F.struct((place - 1 + 3 * front).alias("start"), (place - 1 + 3 * front + F.length(F.regexp_extract(sequence, r, 1))).alias("stop"))
        if not second:
            return F.when(x.wide, _at(sequence, WHOLE[locus], ".*?")).when(x.p > 0, at(x.p, FRONT, first))
        frames = [f".{{{frame}}}(?:...)*?" for frame in range(3)]
        each = F.least(*(F.coalesce(_at(sequence, WHOLE[locus], f), _at(sequence, OTHER_HEAVY, f)) for f in frames))
        nearer = (x.q > 0) & (x.q + 3 * OTHER_FRONT < x.p + 3 * FRONT)
        return F.when(x.wide, each).when((x.p > 0) & ~nearer, at(x.p, FRONT, first)).when(x.p > 0, each).when(x.q > 0, at(x.q, OTHER_FRONT, second))

    return F.transform(F.array(found), placed)[0]  # so that what is found is sought once


def cdr3_start(nt: Column, locus: str) -> Column:
    """FN5: where the CDR3 starts in a V gene, in bases; null if no motif is near its end."""
    aa = nt_to_aa(nt)
    if locus in ("TRA", "TRB"):
        tail = F.right(aa, F.lit(SHORT_TAIL))
        at = F.instr(tail, "C")
        return F.when(at > 0, 3 * (F.length(aa) - F.length(tail) + at))
    tail = F.right(aa, F.lit(TAIL))
    head = F.length(aa) - F.length(tail)
    if locus == "IGH":
        first, second = F.regexp_instr(tail, F.lit(V_END_HEAVY)), F.regexp_instr(tail, F.lit(OTHER_V_END_HEAVY))
        return F.when(first > 0, 3 * (head + first - 1 + FRONT)).when(second > 0, 3 * (head + second))
    if locus not in V_END:
        return F.lit(None).cast("int")
    at = F.regexp_instr(tail, F.lit(V_END[locus]))
    return F.when(at > 0, 3 * (head + at - 1 + F.length(F.regexp_extract(tail, V_END[locus], 0))))


def cdr3_end(nt: Column, locus: str) -> Column:
    """FN6: where the CDR3 ends in a J gene, in bases, in the first frame that has the motif."""
    frames = []
    for frame in range(3):
        at = F.regexp_instr(nt_to_aa(F.substring(nt, F.lit(frame + 1), F.length(nt))), F.lit(J_START[locus]))
        frames.append(F.when(at > 0, (at - 1) * 3 + frame))
    return F.coalesce(*frames)

"""Nearly exact occurrence of terms: the best indel similarity of a term with any window of a text.

A window of the term's length can only reach a threshold if it shares enough
characters with the term, a bound that numpy takes for all windows at once; the
longest common subsequence is computed for the few windows that pass.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from corpusloom.functions.slices import by_slices

#: Windows whose bounds are held at a time.
WINDOWS = 65_536
NONE = 0xFFFFFFFF


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits of one integer."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    rows = (1 << len(a)) - 1
    for c in b:
        hit = rows & masks.get(c, 0)
        rows = (rows + hit | rows - hit) & ((1 << len(a)) - 1)
    return len(a) - rows.bit_count()


def partial_ratio(term: str, text: str, least: float = 0.0) -> float:
    """0 to 100: the best of windows of the term's length, those cut off at the text's ends included.

    Windows that cannot reach ``least`` are not tried; 0 then.
    """
    if not term or not text:
        return 0.0
    if len(term) > len(text):
        term, text = text, term
    m, end = len(term), len(text)
    # beyond both ends stands what no character is, so that all windows are of one length
    edge = np.full(m - 1, NONE, np.uint32)
    codes = np.concatenate([edge, np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), edge])
    counts, best = {c: term.count(c) for c in term}, 0.0
    for first in range(1 - m, end, WINDOWS):
        part = codes[first + m - 1 : first + m - 1 + WINDOWS + m - 1]
        starts = np.arange(first, first + len(part) - m + 1)
        shared = np.zeros(len(starts), np.int64)
        for c, n in counts.items():
            upto = np.concatenate([[0], np.cumsum(part == ord(c))])
            shared += np.minimum(upto[m:] - upto[:-m], n)
        bound = 200.0 * shared / (m + np.minimum(starts + m, end) - np.maximum(starts, 0))
        likely = np.flatnonzero((bound >= least) & (bound > best))
        for i in likely[np.argsort(-bound[likely], kind="stable")].tolist():
            if bound[i] <= best:
                break
            lo, hi = max(first + i, 0), min(first + i + m, end)
            best = max(best, 200.0 * common_length(term, text[lo:hi]) / (m + hi - lo))
        if best >= 100.0:
            break
    return best


def science_hits(text: str | None, terms: Sequence[str], threshold: int = 88, top: int = 5, first: int | None = None) -> tuple[int, list[tuple[str, int]]]:
    """(best score, the ``top`` hits): 100 for a term that occurs, else its partial ratio, from ``threshold`` on.

    The whole text counts, or its ``first`` characters when white space is squeezed.
    """
    low = " ".join((text or "").lower().split())[:first]
    found = []
    for term in terms if low else ():
        t = term.lower()
        score = 100 if t and t in low else int(partial_ratio(t, low, threshold))
        if score >= threshold:
            found.append((term, score))
    found = sorted(found, key=lambda x: -x[1])[:top]
    return (found[0][1] if found else 0), found


def fuzzy_relevance(terms: Sequence[str], threshold: int = 88, top: int = 5, first: int | None = None):
    """The Arrow UDF: struct of score and hits."""

    def run(text):
        score, hits = science_hits(text, terms, threshold, top, first)
        return {"score": score, "hits": [{"term": t, "score": s} for t, s in hits]}

    return by_slices(run, "score int, hits array<struct<term:string,score:int>>")

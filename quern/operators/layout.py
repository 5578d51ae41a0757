"""Reading order of positioned words: a page's columns, and its lines inside each column."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from quern.session import ship

# Fewer words than this make one column; bins of the histogram; the share of the
# peak that a column exceeds; gutter (points, share of the width); most columns; line tolerance.
FEW_WORDS, LEAST_BINS, PEAK_SHARE, GUTTER, GUTTER_SHARE, MOST_COLUMNS, LINE_SHARE = 25, 50, 0.10, 6.0, 0.02, 4, 0.6


def columns(x0: np.ndarray, x1: np.ndarray, gutter: float) -> np.ndarray:
    """(k, 2) left and right edges of the columns that words spanning x0..x1 form.

    Words are counted over bins of the width; a column is a run of bins above a tenth of the
    peak; runs nearer than the gutter are one; too many columns are none.
    """
    left, width = float(x0.min()), float(x1.max() - x0.min())
    whole = np.array([[left, left + width]])
    if width <= 0:
        return whole
    bins = max(LEAST_BINS, int(width))
    step = width / bins
    first = np.maximum(((x0 - left) / step).astype(int), 0)
    last = np.minimum(((x1 - left) / step).astype(int), bins - 1)
    ends = np.zeros(bins + 1, int)
    keep = first <= last
    np.add.at(ends, first[keep], 1)
    np.add.at(ends, last[keep] + 1, -1)
    count = np.cumsum(ends[:-1])
    full = np.concatenate([[False], count > max(1.0, PEAK_SHARE * count.max()), [False]])
    turns = np.flatnonzero(full[1:] != full[:-1])
    if not len(turns):
        return whole
    runs = left + turns.reshape(-1, 2) * step
    apart = runs[1:, 0] - runs[:-1, 1] >= gutter
    merged = np.stack([runs[np.concatenate([[True], apart]), 0], runs[np.concatenate([apart, [True]]), 1]], 1)
    return merged if len(merged) <= MOST_COLUMNS else whole


def _in_lines(words: pd.DataFrame) -> str:
    """Words top to bottom; a line takes what begins within the tolerance of its first word."""
    words = words.sort_values(["top", "x0"], kind="stable")
    heights = np.sort(np.maximum(words["bottom"] - words["top"], 0.0))
    tolerance = LINE_SHARE * (heights[len(heights) // 2] or 1.0)
    line, at, of = -1, None, []
    for top in words["top"]:
        if at is None or abs(top - at) > tolerance:
            line, at = line + 1, top
        of.append(line)
    ordered = words.assign(line=of).sort_values(["line", "x0"], kind="stable")
    return "\n".join(" ".join(g) for _, g in ordered.groupby("line")["text"])


def page_text(words: pd.DataFrame, width: float | None = None) -> str:
    """The text of one page's words (text, x0, x1, top, bottom): column after column."""
    words = words[words["text"].fillna("").str.strip() != ""]
    if words.empty:
        return ""
    x0, x1 = words["x0"].to_numpy(float), words["x1"].to_numpy(float)
    width = x1.max() if width is None or np.isnan(width) else width
    if len(words) < FEW_WORDS:
        return _in_lines(words)
    spans = columns(x0, x1, max(GUTTER, GUTTER_SHARE * width))
    middle = (x0 + x1)[:, None] / 2
    inside = (spans[:, 0] <= middle) & (middle <= spans[:, 1])
    nearest = np.abs(spans.mean(1) - middle).argmin(1)
    own = np.where(inside.any(1), inside.argmax(1), nearest)
    return "\n".join(_in_lines(words[own == k]) for k in range(len(spans)) if (own == k).any())


def read_in_order(words: DataFrame) -> DataFrame:
    """ord, page, text from (ord, page, width, text, x0, x1, top, bottom); a group is one page."""
    ship(words.sparkSession)

    def run(key: tuple, page: pd.DataFrame) -> pd.DataFrame:
        known = page["width"].dropna()
        return pd.DataFrame({"ord": [key[0]], "page": [key[1]], "text": [page_text(page, float(known.iloc[0]) if len(known) else None)]})

    return words.select("ord", "page", "width", "text", "x0", "x1", "top", "bottom").groupBy("ord", "page").applyInPandas(run, "ord long, page long, text string")

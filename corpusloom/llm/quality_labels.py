"""Weak labels: documents that their statistics alone place beyond doubt. Others get none."""

from __future__ import annotations

import numpy as np

from corpusloom.llm.quality_features import NAMES

KINDS = ("prose", "list", "table", "junk")


def weak_labels(f: np.ndarray) -> np.ndarray:
    """Position in KINDS for each row of statistics, -1 where no rule or more than one holds."""
    c = {n: f[:, i] for i, n in enumerate(NAMES)}
    some = c["n_words"] > 0
    repeated = (c["repeat_share"] >= 0.3) | ((c["n_lines"] >= 5) & (c["unique_lines"] <= 0.3)) | ((c["n_words"] >= 30) & (c["rich_words"] <= 1.2))
    html = (c["markup_cells"] >= 0.25) & (c["cell_share"] > 0)
    noise = ((c["symbol_ratio"] >= 0.3) & (c["leader_share"] < 0.3) & (c["common_share"] < 0.1) & (c["unique_words"] > 0.3) & ((c["cell_evenness"] < 0.6) | (c["cell_share"] < 0.75))) | ((c["long_words"] >= 0.3) & (c["cell_share"] < 0.5))
    dump = (c["common_share"] < 0.06) & (c["n_words"] >= 20) & ((c["mean_word"] <= 2.2) | ((c["mixed_words"] + c["number_words"] >= 0.75) & (c["cell_share"] < 0.3) & (c["mark_share"] < 0.6)))
    letters = (c["common_share"] < 0.05) & (c["n_words"] >= 8) & (c["words_per_line"] >= 10) & (c["symbol_ratio"] < 0.03) & (c["unique_words"] >= 0.7)
    script = (c["common_share"] < 0.08) & (c["brace_ratio"] + c["angle_ratio"] >= 0.03) & (c["markup_cells"] < 0.1) & (c["mark_share"] < 0.5)
    script |= (c["script_marks"] >= 0.08) & (c["common_share"] < 0.1) & (c["markup_cells"] < 0.1)
    menu = c["menu_words"] >= 0.5
    bare = (c["cell_evenness"] * c["number_words"] < 0.15) | (c["cell_share"] < 0.5)
    junk = some & ~html & (script | (repeated | noise | dump | letters | menu | (c["broken_ratio"] >= 0.02)) & bare)
    marked = (c["mark_share"] >= 0.6) | (c["leader_share"] >= 0.5) | ((c["key_share"] >= 0.8) & (c["words_per_line"] <= 8)) | ((c["number_end_share"] >= 0.6) & (c["words_per_line"] <= 7))
    options = c["option_share"] >= 0.6
    table = some & (c["cell_share"] >= 0.75) & (c["cell_evenness"] >= 0.6) & (c["common_share"] < 0.2) & (c["n_lines"] >= 3) & ~junk & ~options
    table |= some & html & ~junk
    steps = (c["mark_share"] >= 0.3) & (c["words_per_line"] <= 8) & (c["sentence_end_share"] >= 0.6)
    entries = (c["n_lines"] >= 4) & ((c["words_per_line"] <= 5) | steps | (marked & (c["words_per_line"] <= 24) & ((c["common_share"] < 0.2) | (c["words_per_line"] <= 7)))) & (c["cell_share"] < 0.4)
    entries &= (c["prose_share"] < 0.65) | (c["common_share"] < 0.2) | steps | (marked & (c["words_per_line"] <= 7))
    is_list = some & (entries | (options & (c["n_lines"] >= 3))) & (c["paragraph_share"] < 0.4) & ~junk & ~table
    sentences = (c["common_share"] >= 0.18) & (c["prose_share"] >= 0.7) | (c["common_share"] >= 0.22) & (c["prose_share"] >= 0.6)
    prose = some & sentences & (c["words_per_line"] >= 6) & (c["symbol_ratio"] < 0.18) & (c["broken_ratio"] < 0.005) & ~repeated & ~is_list & ~table & ~junk
    votes = np.stack([prose, is_list, table, junk])
    return np.where(votes.sum(0) == 1, votes.argmax(0), -1)

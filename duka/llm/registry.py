"""Queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

_WHERE = {
    "op1_mix": "mixing", "op2_lm": "lm", "op3_pieces": "pieces", "op4_pii": "pii", "op5_topk": "topk",
    "op6_neardup": "neardup", "op7_html": "htmltext", "op8_merkle": "merkle",
    "op9_language": "langid", "op10_suffix": "suffixdup", "op11_importance": "importance", "op12_exact": "exact", "op13_prefixtrie": "prefixtrie",
}


def queries() -> dict[str, Callable]:
    return {name: getattr(import_module(f"duka.llm.{module}"), name) for name, module in _WHERE.items()}


def oracle_sql() -> dict[str, str]:
    from duka.llm import exact, importance, mixing, prefixtrie, topk
    return {"op1_mix": mixing.ORACLE, "op5_topk": topk.ORACLE, "op11_importance": importance.ORACLE,
            "op12_exact": exact.ORACLE, "op13_prefixtrie": prefixtrie.ORACLE}

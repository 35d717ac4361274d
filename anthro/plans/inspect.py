"""Reading physical plans (OP-D7: show the query instead of running it)."""

from __future__ import annotations

import contextlib
import io
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """``df.explain(mode)`` as a string; nothing is executed."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@dataclass
class PlanNode:
    """One operator of a physical plan.

    ``keys``: a join's left and right keys; ``condition``: a join's or
    filter's further condition; ``pushed``: filters that reach a scan;
    ``columns``: what the node puts out.
    """

    name: str
    depth: int
    text: str
    columns: list[str]
    keys: tuple[list[str], list[str]] = ((), ())
    condition: str | None = None
    pushed: list[str] = field(default_factory=list)
    partitioning: str | None = None
    children: list[PlanNode] = field(default_factory=list)

    def walk(self) -> Iterator[PlanNode]:
        yield self
        for c in self.children:
            yield from c.walk()

    def find(self, pattern: str) -> list[PlanNode]:
        """Nodes whose whole name matches a regular expression."""
        return [n for n in self.walk() if re.fullmatch(pattern, n.name)]


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _plain(expr) -> str:
    """An expression's text without expression ids."""
    return re.sub(r"#\d+L?", "", expr.toString())


def _call(node, method: str):
    """Result of a method that not all nodes have, or None."""
    try:
        return getattr(node, method)()
    except (Py4JError, TypeError):
        return None


def _unwrapped(node):
    """The operator itself, below what adaptive execution puts around it."""
    while True:
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        elif kind.endswith("QueryStageExec"):
            node = node.plan()
        elif kind in ("InputAdapter", "WholeStageCodegenExec"):
            node = node.child()
        else:
            return node


def _node(node, depth: int) -> PlanNode:
    node = _unwrapped(node)
    name = node.getClass().getSimpleName().removesuffix("Exec")
    out = PlanNode(name, depth, re.sub(r"#\d+L?", "", node.simpleString(1000)), [a.name() for a in _items(node.output())])
    if "Join" in name and (left := _call(node, "leftKeys")) is not None:
        out.keys = ([_plain(k) for k in _items(left)], [_plain(k) for k in _items(node.rightKeys())])
    if "Join" in name or name == "Filter":
        condition = _call(node, "condition")
        if condition is not None:
            some = _call(condition, "isDefined")  # a join's is optional
            out.condition = _plain(condition if some is None else condition.get()) if some is not False else None
    if name in ("FileSourceScan", "BatchScan"):
        found = re.search(r"PushedFilters: \[(.*?)\](, ReadSchema|$)", out.text)
        out.pushed = re.findall(r"\w+\((?:[^()]|\([^()]*\))*\)", found.group(1)) if found else []
    if name == "ShuffleExchange":
        out.partitioning = re.sub(r"#\d+L?", "", node.outputPartitioning().toString())
    out.children = [_node(c, depth + 1) for c in _items(node.children())]
    return out


def plan_tree(df: DataFrame) -> PlanNode:
    """The physical plan as data, without adaptive wrappers and codegen spans; nothing is executed."""
    return _node(df._jdf.queryExecution().executedPlan(), 0)

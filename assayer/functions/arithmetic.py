"""Arithmetic templates such as ``({0}+{1})*{2}-{3}`` as Spark SQL text."""

from __future__ import annotations

import ast
import re

from .sqltext import literal

SIGNS = {ast.Add: "+", ast.Sub: "-", ast.Mult: "*"}


def arithmetic(template: str, operands: list[str]) -> str:
    """Fill a template of ``+ - * /``, numbers and brackets with the operands.

    Division by zero gives null, which a rule then counts as unexpected.
    """
    text = re.sub(r"\{(\d+)\}", r"operand_\1", template)
    try:
        tree = ast.parse(text.strip(), mode="eval").body
    except SyntaxError as error:
        raise ValueError(f"cannot read the expression {template!r}") from error
    return _sql(tree, template, operands)


def _sql(node: ast.AST, template: str, operands: list[str]) -> str:
    if isinstance(node, ast.BinOp):
        left, right = (_sql(side, template, operands) for side in (node.left, node.right))
        if isinstance(node.op, ast.Div):
            return f"try_divide({left}, {right})"
        if type(node.op) in SIGNS:
            return f"({left} {SIGNS[type(node.op)]} {right})"
    elif isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.USub, ast.UAdd)):
        inner = _sql(node.operand, template, operands)
        return f"(- {inner})" if isinstance(node.op, ast.USub) else inner
    elif isinstance(node, ast.Constant) and type(node.value) in (int, float):
        return literal(float(node.value))
    elif isinstance(node, ast.Name) and node.id.startswith("operand_"):
        place = int(node.id.removeprefix("operand_"))
        if place < len(operands):
            return operands[place]
        raise ValueError(f"{template!r} asks for column {place}, but only {len(operands)} are given")
    raise ValueError(f"only + - * / , numbers and {{n}} are allowed in {template!r}")

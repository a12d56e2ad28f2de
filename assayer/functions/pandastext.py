"""Row conditions in the style of ``DataFrame.query``, as Spark SQL.

A missing value (null or NaN) meets no comparison but ``!=`` and ``not in``,
and a condition is true or false, never unknown.
"""

from __future__ import annotations

import ast
import io
import re
import tokenize

from pyspark.sql import types as T

from .sqltext import ident, literal

COMPARISONS = {ast.Eq: "=", ast.NotEq: "<>", ast.Lt: "<", ast.LtE: "<=", ast.Gt: ">", ast.GtE: ">="}
ARITHMETIC = {ast.Add: "+", ast.Sub: "-", ast.Mult: "*"}
WORDS = {"&": "and", "|": "or"}
NULL_TESTS = {"isnull": "IS NULL", "isna": "IS NULL", "notnull": "IS NOT NULL", "notna": "IS NOT NULL"}
QUOTED = "quoted_name_{}_"


def pandas_condition(text: str, schema: T.StructType) -> str:
    """The condition as SQL on a table of this schema; a SyntaxError if it is no expression, a ValueError if not allowed.

    Allowed are ``and or not & | ~``, comparisons (also chained, and with a
    list), ``in`` and ``not in``, ``+ - * / %``, column names (odd ones in
    backticks), numbers, texts and lists of them, and the methods ``isnull``,
    ``isna``, ``notnull``, ``notna``, ``isin``, ``between``,
    ``str.startswith``, ``str.endswith`` and ``str.contains``.
    """
    names: list[str] = []

    def named(match: re.Match) -> str:
        if match[1] is None:
            return match[0]
        names.append(match[1])
        return QUOTED.format(len(names) - 1)

    plain = re.sub(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`([^`]*)`", named, text.strip().replace("\n", " "))
    tokens = [
        (tokenize.NAME, WORDS[t.string]) if t.type == tokenize.OP and t.string in WORDS else (t.type, t.string)
        for t in tokenize.generate_tokens(io.StringIO(plain).readline)
        if t.type not in (tokenize.NEWLINE, tokenize.NL, tokenize.ENDMARKER)
    ]
    tree = ast.parse(tokenize.untokenize(tokens).strip(), mode="eval")
    aliases = {QUOTED.format(i): name for i, name in enumerate(names)}
    return _Writer(schema, aliases).truth(tree.body)


class _Writer:
    def __init__(self, schema: T.StructType, aliases: dict[str, str]):
        self.schema, self.aliases = schema, aliases

    def truth(self, node: ast.expr) -> str:
        """A condition: true or false."""
        if isinstance(node, ast.BoolOp):
            word = " AND " if isinstance(node.op, ast.And) else " OR "
            return "(" + word.join(map(self.truth, node.values)) + ")"
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.Not, ast.Invert)):
            return f"(NOT {self.truth(node.operand)})"
        if isinstance(node, ast.Compare):
            sides = [node.left, *node.comparators]
            steps = [self.compared(a, op, b) for a, op, b in zip(sides, node.ops, sides[1:])]
            return steps[0] if len(steps) == 1 else "(" + " AND ".join(steps) + ")"
        if isinstance(node, ast.Call):
            return self.method(node)
        if isinstance(node, ast.Constant) and isinstance(node.value, bool):
            return literal(node.value)
        if isinstance(node, ast.Name):
            return f"coalesce({self.value(node)}, false)"
        raise ValueError(f"{ast.unparse(node)!r} is not a condition")

    def compared(self, left: ast.expr, op: ast.cmpop, right: ast.expr) -> str:
        if isinstance(left, (ast.List, ast.Tuple)):
            left, right = right, left
        if isinstance(right, (ast.List, ast.Tuple)):
            if not isinstance(op, (ast.In, ast.NotIn, ast.Eq, ast.NotEq)):
                raise ValueError("a list can only be compared by in, not in, == and !=")
            return self.member(left, right, isinstance(op, (ast.NotIn, ast.NotEq)))
        if type(op) not in COMPARISONS:
            raise ValueError("in and not in need a list")
        unknown = "true" if isinstance(op, ast.NotEq) else "false"
        return f"coalesce({self.value(left)} {COMPARISONS[type(op)]} {self.value(right)}, {unknown})"

    def member(self, item: ast.expr, members: ast.expr, absent: bool) -> str:
        """``isin``; a None among the members stands for missing values."""
        given = [self.constant(e) for e in members.elts]
        value = self.value(item)
        tests = [f"coalesce({value} IN ({', '.join(literal(g) for g in given if g is not None)}), false)"]
        tests = tests if any(g is not None for g in given) else ["false"]
        tests += [f"{value} IS NULL"] if None in given else []
        found = tests[0] if len(tests) == 1 else f"({' OR '.join(tests)})"
        return f"(NOT {found})" if absent else found

    def method(self, node: ast.Call) -> str:
        function = node.func
        if not isinstance(function, ast.Attribute) or node.keywords:
            raise ValueError(f"{ast.unparse(node)!r} is not allowed")
        owner, name = function.value, function.attr
        if name in NULL_TESTS and not node.args:
            return f"({self.value(owner)} {NULL_TESTS[name]})"
        if name == "isin" and len(node.args) == 1 and isinstance(node.args[0], (ast.List, ast.Tuple)):
            return self.member(owner, node.args[0], absent=False)
        if name == "between" and len(node.args) == 2:
            low, high = map(self.value, node.args)
            return f"coalesce({self.value(owner)} BETWEEN {low} AND {high}, false)"
        if isinstance(owner, ast.Attribute) and owner.attr == "str" and len(node.args) == 1:
            text = literal(str(self.constant(node.args[0])))
            value = self.value(owner.value)
            tests = {"startswith": f"startswith({value}, {text})", "endswith": f"endswith({value}, {text})"}
            tests["contains"] = f"{value} RLIKE {text}"
            if name in tests:
                return f"coalesce({tests[name]}, false)"
        raise ValueError(f"{ast.unparse(node)!r} is not allowed")

    def value(self, node: ast.expr) -> str:
        """A number, text or column; null where it is missing."""
        if isinstance(node, ast.Name):
            name = self.aliases.get(node.id, node.id)
            if name not in self.schema.fieldNames():
                raise KeyError(f"column {name!r} does not exist")
            is_float = isinstance(self.schema[name].dataType, (T.DoubleType, T.FloatType))
            return f"nanvl({ident(name)}, NULL)" if is_float else ident(name)
        if isinstance(node, ast.BinOp) and type(node.op) in ARITHMETIC:
            return f"({self.value(node.left)} {ARITHMETIC[type(node.op)]} {self.value(node.right)})"
        if isinstance(node, ast.BinOp) and isinstance(node.op, ast.Div):
            return f"try_divide({self.value(node.left)}, {self.value(node.right)})"
        if isinstance(node, ast.BinOp) and isinstance(node.op, ast.Mod):
            right = self.value(node.right)  # its sign is that of the divisor
            return f"try_mod(try_mod({self.value(node.left)}, {right}) + {right}, {right})"
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub) and not isinstance(node.operand, ast.Constant):
            return f"(-{self.value(node.operand)})"
        return literal(self.constant(node))

    def constant(self, node: ast.expr):
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.USub, ast.UAdd)):
            value = self.constant(node.operand)
            if isinstance(value, (int, float)):
                return -value if isinstance(node.op, ast.USub) else value
        if isinstance(node, ast.Constant) and isinstance(node.value, (int, float, str, bool, type(None))):
            return node.value
        raise ValueError(f"{ast.unparse(node)!r} is not allowed")

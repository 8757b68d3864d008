"""Request templates: a declared subset turned into columns, nothing is evaluated.

A template is the text of a dictionary with the arguments of a request (``method``,
``url``, ``json`` or ``data``, ``files``, ``headers``, ``params``, ``auth``). Text in it
may hold ``{{ database_identifier }}``, ``{{ community }}``, ``{{ community_identifier }}``
and ``{{ filtered_data["column"][position] }}``; the bare name ``data_file`` stands for
the result file.
"""

from __future__ import annotations

import ast
import json
import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataflow.functions.text import json_string, or_empty
from strataflow.schema import CATALOGUE_COLUMNS

# Names a placeholder may use, request arguments a template may set.
VARIABLES = {
    "database_identifier": "database_identifier",
    "community": "community_name",
    "community_identifier": "community_id",
}
ARGUMENTS = ("method", "url", "json", "data", "files", "headers", "params", "auth")
FILE_NAME = "data_file"

_PLACEHOLDER = re.compile(r"\{\{(.*?)\}\}", re.DOTALL)
_CELL = re.compile(r"filtered_data\[\s*(['\"])(\w+)\1\s*\]\[\s*(\d+)\s*\]")
# Placeholders are numbered between two private characters while the text is parsed.
_MARK = "\ue000{}\ue001"
_MARKED = re.compile("\ue000(\\d+)\ue001")


class TemplateError(ValueError):
    """The template is outside the supported subset."""


def cell_name(column: str, position: int) -> str:
    return f"cell_{column}_{position}"


@dataclass
class Template:
    """A parsed template: arguments with marks in place of placeholders."""

    arguments: dict
    placeholders: list[str] = field(default_factory=list)
    cells: set[tuple[str, int]] = field(default_factory=set)
    uses_file: bool = False

    def _pieces(self, text: str) -> list[Column | str]:
        parts = _MARKED.split(text)
        return [F.col(self.placeholders[int(p)]) if i % 2 else p for i, p in enumerate(parts) if i % 2 or p]

    def text(self, value: str) -> Column:
        pieces = [F.lit(p) if isinstance(p, str) else or_empty(p) for p in self._pieces(value)]
        return F.concat(*pieces) if pieces else F.lit("")

    def json(self, value) -> Column:
        """JSON text of a template value."""
        if isinstance(value, str):
            if not _MARKED.search(value):
                return F.lit(json.dumps(value, ensure_ascii=False))
            return json_string(self.text(value))
        if isinstance(value, dict):
            fields = [F.concat(F.lit(json.dumps(k) + ":"), self.json(v)) for k, v in value.items()]
            return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
        if isinstance(value, (list, tuple)):
            return F.concat(F.lit("["), F.concat_ws(",", *[self.json(v) for v in value]), F.lit("]"))
        return F.lit(json.dumps(value))

    def columns(self) -> dict[str, Column]:
        """Columns ``method``, ``url``, ``body``, ``options`` and ``file_field`` of a request."""
        body = self.arguments.get("json", self.arguments.get("data"))
        options = {k: v for k, v in self.arguments.items() if k in ("headers", "params", "auth")}
        files = self.arguments.get("files") or {}
        text_type = F.lit(None).cast("string")
        return {
            "method": F.lit(str(self.arguments.get("method", "POST")).upper()),
            "url": self.text(self.arguments["url"]),
            "body": text_type if body is None else self.json(body),
            "options": self.json(options) if options else text_type,
            "file_field": F.lit(next(iter(files))) if files else text_type,
        }


def parse_template(source: str) -> Template:
    template = Template({})

    def mark(match: re.Match) -> str:
        name = match.group(1).strip()
        cell = _CELL.fullmatch(name)
        if cell:
            column, position = cell.group(2), int(cell.group(3))
            if column not in CATALOGUE_COLUMNS:
                raise TemplateError(f"unknown column in template: {column}")
            template.cells.add((column, position))
            template.placeholders.append(cell_name(column, position))
        elif name in VARIABLES:
            template.placeholders.append(VARIABLES[name])
        else:
            raise TemplateError(f"unsupported placeholder: {name}")
        return _MARK.format(len(template.placeholders) - 1)

    try:
        tree = ast.parse(_PLACEHOLDER.sub(mark, source).strip(), mode="eval").body
    except SyntaxError as error:
        raise TemplateError(f"template is not a dictionary of arguments: {error}") from error
    for node in ast.walk(tree):
        if isinstance(node, ast.Name):
            if node.id != FILE_NAME:
                raise TemplateError(f"unknown name in template: {node.id}")
            template.uses_file = True
    tree = _FileName().visit(tree)
    try:
        template.arguments = ast.literal_eval(tree)
    except ValueError as error:
        raise TemplateError("a template may hold plain values only") from error
    if not isinstance(template.arguments, dict) or "url" not in template.arguments:
        raise TemplateError("a template is a dictionary with a url")
    unknown = set(template.arguments) - set(ARGUMENTS)
    if unknown:
        raise TemplateError(f"unsupported arguments: {sorted(unknown)}")
    return template


class _FileName(ast.NodeTransformer):
    def visit_Name(self, node: ast.Name) -> ast.Constant:
        return ast.copy_location(ast.Constant(FILE_NAME), node)

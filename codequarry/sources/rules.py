"""Rule catalogue: which tree shapes are definitions, calls and imports.

A rule is read bottom-up from the captured node: its type and field, then up to three ancestors. ``None``
matches anything (a name type of ``None`` matches any *named* node). ``kind_level`` says which ancestor
(1 = parent) carries the construct's position. A guard asks for a sibling of the captured node.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    family: str
    lang: str
    pattern_ix: int
    kind: str
    name_type: str | None
    name_field: str | None
    t1: str
    f1: str | None = None
    t2: str | None = None
    f2: str | None = None
    t3: str | None = None
    guard_field: str | None = None
    guard_types: tuple[str, ...] = ()

    @property
    def kind_level(self) -> int:
        return 1 + (self.t2 is not None) + (self.t3 is not None)


_CLOSURE = ("arrow_function", "function_expression")

# Language, kind, name type, name field, parent, (field, grandparent)..., guard.
_DEFINITIONS = [
    ("python", "function", "identifier", "name", "function_definition"),
    ("python", "class", "identifier", "name", "class_definition"),
    ("javascript", "function", "identifier", "name", "function_declaration"),
    ("javascript", "method", "property_identifier", "name", "method_definition"),
    ("javascript", "class", "identifier", "name", "class_declaration"),
    ("javascript", "function", "identifier", "name", "variable_declarator", {"value": _CLOSURE}),
    ("javascript", "export", "identifier", "name", "function_declaration", "declaration", "export_statement"),
    ("javascript", "export", "identifier", "name", "class_declaration", "declaration", "export_statement"),
    ("javascript", "export", "identifier", "name", "variable_declarator", None, "lexical_declaration",
     "declaration", "export_statement", {"value": _CLOSURE}),
    *[
        (lang, *rest)
        for lang in ("typescript", "tsx")
        for rest in [
            ("function", "identifier", "name", "function_declaration"),
            ("method", "property_identifier", "name", "method_definition"),
            ("class", "type_identifier", "name", "class_declaration"),
            ("interface", "type_identifier", "name", "interface_declaration"),
            ("type", "type_identifier", "name", "type_alias_declaration"),
            ("enum", "identifier", "name", "enum_declaration"),
            ("function", "identifier", "name", "variable_declarator", {"value": _CLOSURE}),
            ("export", "identifier", "name", "variable_declarator", None, "lexical_declaration",
             "declaration", "export_statement", {"value": _CLOSURE}),
        ]
    ],
    ("go", "function", "identifier", "name", "function_declaration"),
    ("go", "method", "field_identifier", "name", "method_declaration"),
    ("go", "struct", "type_identifier", "name", "type_spec", None, "type_declaration", {"type": ("struct_type",)}),
    ("go", "interface", "type_identifier", "name", "type_spec", None, "type_declaration",
     {"type": ("interface_type",)}),
    ("go", "type", "type_identifier", "name", "type_spec", None, "type_declaration"),
    ("rust", "function", "identifier", "name", "function_item"),
    ("rust", "impl", "type_identifier", "type", "impl_item"),
    ("rust", "struct", "type_identifier", "name", "struct_item"),
    ("rust", "enum", "type_identifier", "name", "enum_item"),
    ("rust", "trait", "type_identifier", "name", "trait_item"),
    ("c", "function", "identifier", "declarator", "function_declarator", "declarator", "function_definition"),
    ("c", "struct", "type_identifier", "name", "struct_specifier"),
    ("cpp", "function", "identifier", "declarator", "function_declarator", "declarator", "function_definition"),
    ("cpp", "method", "qualified_identifier", "declarator", "function_declarator", "declarator",
     "function_definition"),
    ("cpp", "class", "type_identifier", "name", "class_specifier"),
    ("cpp", "struct", "type_identifier", "name", "struct_specifier"),
    ("java", "method", "identifier", "name", "method_declaration"),
    ("java", "class", "identifier", "name", "class_declaration"),
    ("java", "interface", "identifier", "name", "interface_declaration"),
    ("java", "constructor", "identifier", "name", "constructor_declaration"),
    ("ruby", "method", "identifier", "name", "method"),
    ("ruby", "class", "constant", "name", "class"),
    ("ruby", "module", "constant", "name", "module"),
    ("bash", "function", "word", "name", "function_definition"),
    ("php", "function", "name", "name", "function_definition"),
    ("php", "method", "name", "name", "method_declaration"),
    ("php", "class", "name", "name", "class_declaration"),
    ("php", "interface", "name", "name", "interface_declaration"),
]

# Language, callee type, callee field, parent, (field, grandparent). One row per alternative.
_CALLS = [
    ("python", "identifier", "function", "call"),
    ("python", "identifier", "attribute", "attribute", "function", "call"),
    *[
        (lang, *rest)
        for lang in ("javascript", "typescript", "tsx")
        for rest in [
            ("identifier", "function", "call_expression"),
            ("property_identifier", "property", "member_expression", "function", "call_expression"),
        ]
    ],
    ("go", "identifier", "function", "call_expression"),
    ("go", "field_identifier", "field", "selector_expression", "function", "call_expression"),
    ("rust", "identifier", "function", "call_expression"),
    ("rust", "field_identifier", "field", "field_expression", "function", "call_expression"),
    ("rust", "identifier", "name", "scoped_identifier", "function", "call_expression"),
    ("c", "identifier", "function", "call_expression"),
    ("c", "field_identifier", "field", "field_expression", "function", "call_expression"),
    ("cpp", "identifier", "function", "call_expression"),
    ("cpp", "field_identifier", "field", "field_expression", "function", "call_expression"),
    ("cpp", "identifier", "name", "qualified_identifier", "function", "call_expression"),
    ("java", "identifier", "name", "method_invocation"),
    ("ruby", "identifier", "method", "call"),
    ("bash", "command_name", "name", "command"),
    ("php", "name", "function", "function_call_expression"),
    ("php", "qualified_name", "function", "function_call_expression"),
    ("php", "name", "name", "member_call_expression"),
    ("php", "name", "name", "scoped_call_expression"),
]

# Language, module type, module field, import statement.
_IMPORTS = [
    ("python", "dotted_name", "name", "import_statement"),
    ("python", "dotted_name", "module_name", "import_from_statement"),
    ("javascript", "string", "source", "import_statement"),
    ("typescript", "string", "source", "import_statement"),
    ("tsx", "string", "source", "import_statement"),
    ("go", "interpreted_string_literal", "path", "import_spec"),
    ("rust", None, "argument", "use_declaration"),
]


def rule_set(family: str, rows: Sequence[tuple]) -> list[Rule]:
    """Rules from (lang, kind, name type, name field, parent, field, grandparent, ..., guard) tuples.

    ``pattern_ix`` counts rows within a language. A guard is a dict {field: allowed types} in last place.
    """
    rules: list[Rule] = []
    for row in rows:
        guard: dict = {}
        if isinstance(row[-1], dict):
            *row, guard = row
        lang, kind, name_type, name_field, *path = row
        index = sum(r.lang == lang for r in rules)
        field, types = next(iter(guard.items()), (None, ()))
        rules.append(
            Rule(family, lang, index, kind, name_type, name_field, *path, guard_field=field, guard_types=tuple(types))
        )
    return rules


def _with_kind(kind: str, rows: Sequence[tuple]) -> list[tuple]:
    return [(lang, kind, *rest) for lang, *rest in rows]


DEFINITION_RULES = rule_set("definition", _DEFINITIONS)
CALL_RULES = rule_set("call", _with_kind("call", _CALLS))
IMPORT_RULES = rule_set("import", _with_kind("import", _IMPORTS))
RULES = DEFINITION_RULES + CALL_RULES + IMPORT_RULES


def rules_table(spark: SparkSession, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Rules as a DataFrame, one row each (85 for the built-in catalogue)."""
    kinds = {"pattern_ix": T.IntegerType(), "guard_types": T.ArrayType(T.StringType())}
    schema = T.StructType(
        [T.StructField(f.name, kinds.get(f.name, T.StringType())) for f in fields(Rule)]
        + [T.StructField("kind_level", T.IntegerType())]
    )
    rows = [(*(list(v) if isinstance(v, tuple) else v for v in astuple(r)), r.kind_level) for r in rules]
    return spark.createDataFrame(rows, schema)

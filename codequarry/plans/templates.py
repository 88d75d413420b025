"""Small syntax trees with their text, from which the test corpus is assembled.

Each language has a header (imports) and variants (blocks). A template is a list of nodes; plain strings
between nodes are blanks without a node. ``{name}``, ``{callee}`` and ``{module}`` stand for texts of fixed
width, so every offset is known. Next to each tree stands what it must yield, written down by hand:

* ``defs``: (kind, name, start row, end row, row of the name), after the dedupe;
* ``calls``: (name, row); ``imports``: (module, row, raw text).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Stand-ins with the width of the real texts: n_<12 digits>, price_<2 digits>, mod_<2 digits>.
PLACEHOLDERS = {"{name}": "n_000000000000", "{callee}": "price_00", "{module}": "mod_00"}


@dataclass(frozen=True)
class Node:
    type: str
    kids: tuple = ()
    text: str | None = None
    field: str | None = None
    named: bool = True
    is_error: bool = False
    is_missing: bool = False


@dataclass(frozen=True)
class Template:
    items: tuple
    defs: list = field(default_factory=list)
    calls: list = field(default_factory=list)
    imports: list = field(default_factory=list)


def n(type_: str, *kids, field: str | None = None, error: bool = False) -> Node:
    return Node(type_, kids, None, field, is_error=error)


def leaf(type_: str, text: str, field: str | None = None) -> Node:
    return Node(type_, (), text, field)


def t(text: str, field: str | None = None) -> Node:
    return Node(text, (), text, field, named=False)


def missing(text: str) -> Node:
    return Node(text, (), "", None, named=False, is_missing=True)


def ident(text: str, field: str | None = None) -> Node:
    return leaf("identifier", text, field)


def num(text: str = "1") -> Node:
    return leaf("number", text)


def block(*items, defs=(), calls=(), imports=()) -> Template:
    return Template(items, list(defs), list(calls), list(imports))


# ---------------------------------------------------------------- python
def _py_args(*kids, field="arguments"):
    return n("argument_list", t("("), *kids, t(")"), field=field)


def _py_call(*args):
    return n("call", ident("{callee}", "function"), _py_args(*args))


def _py_def(name, params, *body):
    return n("function_definition", t("def"), " ", ident(name, "name"),
             n("parameters", t("("), *params, t(")"), field="parameters"), t(":"), *body)


PYTHON = [
    block(
        n("import_statement", t("import"), " ", n("dotted_name", ident("{module}"), field="name")), "\n",
        n("import_from_statement", t("from"), " ", n("dotted_name", ident("{module}"), field="module_name"), " ",
          t("import"), " ", n("dotted_name", ident("z"), field="name")), "\n",
        n("import_statement", t("import"), " ",
          n("aliased_import", n("dotted_name", ident("{module}"), field="name"), " ", t("as"), " ",
            ident("m", "alias"), field="name")), "\n",
        n("import_from_statement", t("from"), " ", n("relative_import", n("import_prefix", t(".")), field="module_name"),
          " ", t("import"), " ", n("dotted_name", ident("z"), field="name")), "\n",
        imports=[("{module}", 0, "import {module}"), ("{module}", 1, "from {module} import z")],
    ),
    block(
        _py_def("{name}", [ident("q")], "\n    ",
                n("block", n("return_statement", t("return"), " ", _py_call(ident("q"))), field="body")), "\n",
        defs=[("function", "{name}", 0, 1, 0)], calls=[("{callee}", 1)],
    ),
    block(
        n("class_definition", t("class"), " ", ident("{name}", "name"), t(":"), "\n    ",
          n("block", _py_def("run", [ident("self")], "\n        ",
                             n("block", n("return_statement", t("return"), " ",
                                          n("call", n("attribute", ident("self", "object"), t("."),
                                                      ident("{callee}", "attribute"), field="function"),
                                            _py_args())), field="body")), field="body")), "\n",
        defs=[("class", "{name}", 0, 2, 0), ("function", "run", 1, 2, 1)], calls=[("{callee}", 2)],
    ),
    block(
        n("expression_statement", n("assignment", ident("x", "left"), " ", t("="), " ",
                                    n("call", ident("{callee}", "function"), _py_args(num()), field="right"))),
        "  ", leaf("comment", "# def {name}(): uses {callee}(2)"), "\n",
        calls=[("{callee}", 0)],
    ),
    block(
        n("decorated_definition", n("decorator", t("@"), ident("wrap")), "\n",
          _py_def("{name}", [], "\n    ",
                  n("block", n("expression_statement", n("string", leaf("string_start", "'"),
                                                         leaf("string_content", "{name} ("),
                                                         leaf("string_end", "'"))), field="body"))), "\n\n",
        defs=[("function", "{name}", 1, 2, 1)],
    ),
    block(
        n("expression_statement", n("string", leaf("string_start", 'f"'),
                                    n("interpolation", t("{"), ident("{name}", "expression"), t("}")),
                                    leaf("string_end", '"'))), "\n",
        n("ERROR", t(")"), error=True), missing(":"), "\n",
    ),
]


# ---------------------------------------------------------------- javascript, typescript, tsx
def _js_string(text):
    return n("string", t('"'), leaf("string_fragment", text), t('"'), field="source")


def _js_import():
    return n("import_statement", t("import"), " ", n("import_clause", ident("y")), " ", t("from"), " ",
             _js_string("{module}"), t(";"))


def _js_call(*args, field=None):
    return n("call_expression", ident("{callee}", "function"),
             n("arguments", t("("), *args, t(")"), field="arguments"), field=field)


def _js_params(*kids):
    return n("formal_parameters", t("("), *kids, t(")"), field="parameters")


def _js_body(*kids):
    return n("statement_block", t("{"), *kids, t("}"), field="body")


def _js_function(name, field=None):
    return n("function_declaration", t("function"), " ", ident(name, "name"), _js_params(ident("q")), " ",
             _js_body(" ", n("return_statement", t("return"), " ", _js_call(ident("q")), t(";")), " "), field=field)


def _js_arrow(field=None):
    return n("lexical_declaration", t("const", "kind"), " ",
             n("variable_declarator", ident("{name}", "name"), " ", t("="), " ",
               n("arrow_function", _js_params(), " ", t("=>"), " ", _js_call(num(), field="body"), field="value")),
             t(";"), field=field)


def _js_class(name_type, field=None):
    return n("class_declaration", t("class"), " ", leaf(name_type, "{name}", "name"), " ",
             n("class_body", t("{"), "\n  ",
               n("method_definition", leaf("property_identifier", "run", "name"), _js_params(), " ",
                 _js_body(" ", n("return_statement", t("return"), " ",
                                 n("call_expression",
                                   n("member_expression", leaf("this", "this", "object"), t("."),
                                     leaf("property_identifier", "{callee}", "property"), field="function"),
                                   n("arguments", t("("), t(")"), field="arguments")), t(";")), " ")),
               "\n", t("}"), field="body"), field=field)


def _js_constant():
    return n("lexical_declaration", t("const", "kind"), " ",
             n("variable_declarator", ident("{name}", "name"), " ", t("="), " ",
               leaf("number", "4", "value")), t(";"))


def _js_template_text():
    return n("expression_statement",
             n("template_string", t("`"), n("template_substitution", t("${"), ident("{name}"), t("}")), t("`")), t(";"))


def _js_export(decl):
    return n("export_statement", t("export"), " ", decl)


_JS_COMMON = [
    block(_js_function("{name}"), "\n", defs=[("function", "{name}", 0, 0, 0)], calls=[("{callee}", 0)]),
    block(_js_arrow(), "\n", defs=[("function", "{name}", 0, 0, 0)], calls=[("{callee}", 0)]),
    block(_js_constant(), "  ", leaf("comment", "// function {name}() uses {callee}()"), "\n"),
    block(_js_export(_js_arrow("declaration")), "\n", defs=[("export", "{name}", 0, 0, 0)], calls=[("{callee}", 0)]),
    block(_js_template_text(), "\n", n("ERROR", ident("oops"), error=True), missing(";"), "\n"),
]

JAVASCRIPT = [
    block(_js_import(), "\n", imports=[("{module}", 0, 'import y from "{module}";')]),
    *_JS_COMMON,
    block(_js_class("identifier"), "\n", defs=[("class", "{name}", 0, 2, 0), ("method", "run", 1, 1, 1)],
          calls=[("{callee}", 1)]),
    block(_js_export(_js_function("{name}", "declaration")), "\n", defs=[("export", "{name}", 0, 0, 0)],
          calls=[("{callee}", 0)]),
    block(_js_export(_js_class("identifier", "declaration")), "\n",
          defs=[("class", "{name}", 0, 2, 0), ("method", "run", 1, 1, 1)], calls=[("{callee}", 1)]),
    block(_js_function("a{name}"), " ", _js_function("b{name}"), "\n",
          defs=[("function", "a{name}", 0, 0, 0), ("function", "b{name}", 0, 0, 0)],
          calls=[("{callee}", 0), ("{callee}", 0)]),
    block(n("lexical_declaration", t("const", "kind"), " ",
            n("variable_declarator", ident("{name}", "name"), " ", t("="), " ",
              n("function_expression", t("function"), " ", _js_params(), " ", _js_body(), field="value")),
            t(";")), "\n\n", defs=[("function", "{name}", 0, 0, 0)]),
]

TYPESCRIPT = [
    block(_js_import(), "\n", imports=[("{module}", 0, 'import y from "{module}";')]),
    *_JS_COMMON,
    block(_js_class("type_identifier"), "\n", defs=[("class", "{name}", 0, 2, 0), ("method", "run", 1, 1, 1)],
          calls=[("{callee}", 1)]),
    block(_js_export(_js_function("{name}", "declaration")), "\n", defs=[("function", "{name}", 0, 0, 0)],
          calls=[("{callee}", 0)]),
    block(n("interface_declaration", t("interface"), " ", leaf("type_identifier", "{name}", "name"), " ",
            n("interface_body", t("{"), "\n", t("}"), field="body")), "\n",
          defs=[("interface", "{name}", 0, 1, 0)]),
    block(n("type_alias_declaration", t("type"), " ", leaf("type_identifier", "{name}", "name"), " ", t("="), " ",
            leaf("predefined_type", "string", "value"), t(";")), "\n", defs=[("type", "{name}", 0, 0, 0)]),
    block(n("enum_declaration", t("enum"), " ", ident("{name}", "name"), " ",
            n("enum_body", t("{"), " ", leaf("property_identifier", "A"), " ", t("}"), field="body")), "\n",
          defs=[("enum", "{name}", 0, 0, 0)]),
]


# ---------------------------------------------------------------- go
def _go_call(*args):
    return n("call_expression", ident("{callee}", "function"),
             n("argument_list", t("("), *args, t(")"), field="arguments"))


def _go_type(kind, *body):
    return n("type_spec", leaf("type_identifier", "{name}", "name"), " ", n(kind, *body, field="type"))


def _go_body(*kids):
    return n("block", t("{"), "\n\t", *kids, "\n", t("}"), field="body")


GO = [
    block(n("import_declaration", t("import"), " ",
            n("import_spec", leaf("interpreted_string_literal", '"{module}"', "path"))), "\n",
          imports=[("{module}", 0, '"{module}"')]),
    block(n("function_declaration", t("func"), " ", ident("{name}", "name"),
            n("parameter_list", t("("), t(")"), field="parameters"), " ",
            _go_body(n("expression_statement", _go_call(leaf("int_literal", "1"))))), "\n",
          defs=[("function", "{name}", 0, 2, 0)], calls=[("{callee}", 1)]),
    block(n("method_declaration", t("func"), " ",
            n("parameter_list", t("("), ident("r"), " ", leaf("type_identifier", "T"), t(")"), field="receiver"), " ",
            leaf("field_identifier", "{name}", "name"), n("parameter_list", t("("), t(")"), field="parameters"), " ",
            _go_body(n("expression_statement",
                       n("call_expression",
                         n("selector_expression", ident("r", "operand"), t("."),
                           leaf("field_identifier", "{callee}", "field"), field="function"),
                         n("argument_list", t("("), t(")"), field="arguments"))))), "\n",
          defs=[("method", "{name}", 0, 2, 0)], calls=[("{callee}", 1)]),
    block(n("type_declaration", t("type"), " ", _go_type("struct_type", t("struct"), " ", t("{"), "\n", t("}"))), "\n",
          defs=[("struct", "{name}", 0, 1, 0)]),
    block(n("type_declaration", t("type"), " ", _go_type("interface_type", t("interface"), " ", t("{"), "\n", t("}"))),
          "\n", defs=[("interface", "{name}", 0, 1, 0)]),
    block(n("type_declaration", t("type"), " ",
            n("type_spec", leaf("type_identifier", "{name}", "name"), " ", leaf("type_identifier", "int", "type"))),
          "\n", defs=[("type", "{name}", 0, 0, 0)]),
    block(n("type_declaration", t("type"), " ", t("("), "\n\t",
            n("type_spec", leaf("type_identifier", "A{name}", "name"), " ", leaf("type_identifier", "int", "type")),
            "\n\t", _go_type("struct_type", t("struct"), " ", t("{"), t("}")), "\n", t(")")), "\n",
          defs=[("type", "A{name}", 0, 3, 1), ("struct", "{name}", 0, 3, 2)]),
]


# ---------------------------------------------------------------- rust
def _rust_args():
    return n("arguments", t("("), t(")"), field="arguments")


def _rust_braces(type_, *kids):
    return n(type_, t("{"), *kids, t("}"), field="body")


RUST = [
    block(n("use_declaration", t("use"), " ",
            n("scoped_identifier", ident("{module}", "path"), t("::"), ident("z", "name"), field="argument"),
            t(";")), "\n", imports=[("{module}::z", 0, "use {module}::z;")]),
    block(n("function_item", t("fn"), " ", ident("{name}", "name"), n("parameters", t("("), t(")"), field="parameters"),
            " ", _rust_braces("block", "\n    ", n("expression_statement",
                                                   n("call_expression", ident("{callee}", "function"), _rust_args()),
                                                   t(";")), "\n")), "\n",
          defs=[("function", "{name}", 0, 2, 0)], calls=[("{callee}", 1)]),
    block(n("struct_item", t("struct"), " ", leaf("type_identifier", "{name}", "name"), t(";")), "\n",
          n("impl_item", t("impl"), " ", leaf("type_identifier", "{name}", "type"), " ",
            _rust_braces("declaration_list", "\n    ",
                         n("function_item", t("fn"), " ", ident("run", "name"),
                           n("parameters", t("("), t(")"), field="parameters"), " ",
                           _rust_braces("block", " ",
                                        n("call_expression",
                                          n("field_expression", leaf("self", "self", "value"), t("."),
                                            leaf("field_identifier", "{callee}", "field"), field="function"),
                                          _rust_args()), " ")), "\n")), "\n",
          defs=[("struct", "{name}", 0, 0, 0), ("impl", "{name}", 1, 3, 1), ("function", "run", 2, 2, 2)],
          calls=[("{callee}", 2)]),
    block(n("enum_item", t("enum"), " ", leaf("type_identifier", "{name}", "name"), " ",
            _rust_braces("enum_variant_list", " ", n("enum_variant", ident("A", "name")), " ")), "\n",
          defs=[("enum", "{name}", 0, 0, 0)]),
    block(n("trait_item", t("trait"), " ", leaf("type_identifier", "{name}", "name"), " ",
            _rust_braces("declaration_list", "\n")), "\n", defs=[("trait", "{name}", 0, 1, 0)]),
    block(n("const_item", t("const"), " ", ident("X", "name"), t(":"), " ", leaf("primitive_type", "i32", "type"), " ",
            t("="), " ", n("call_expression",
                           n("scoped_identifier", ident("m", "path"), t("::"), ident("{callee}", "name"),
                             field="function"), _rust_args(), field="value"), t(";")), " ",
          leaf("line_comment", "// fn {name}() calls {callee}()"), "\n", calls=[("{callee}", 0)]),
]


# ---------------------------------------------------------------- c, cpp
def _c_function(name_node, *body):
    return n("function_definition", leaf("primitive_type", "int", "type"), " ",
             n("function_declarator", name_node, n("parameter_list", t("("), t(")"), field="parameters"),
               field="declarator"), " ",
             n("compound_statement", t("{"), "\n  ", *body, "\n", t("}"), field="body"))


def _c_return(callee):
    return n("return_statement", t("return"), " ",
             n("call_expression", callee, n("argument_list", t("("), t(")"), field="arguments")), t(";"))


def _c_record(type_, word):
    return n(type_, t(word), " ", leaf("type_identifier", "{name}", "name"), " ",
             n("field_declaration_list", t("{"), "\n", t("}"), field="body"))


_ARROW_CALL = n("field_expression", ident("p", "argument"), t("->", "operator"),
                leaf("field_identifier", "{callee}", "field"), field="function")
C = [
    block(n("preproc_include", t("#include"), " ", n("string_literal", t('"'), leaf("string_content", "{module}.h"), t('"'),
                                                   field="path")), "\n"),
    block(_c_function(ident("{name}", "declarator"), _c_return(ident("{callee}", "function"))), "\n",
          defs=[("function", "{name}", 0, 2, 0)], calls=[("{callee}", 1)]),
    block(_c_record("struct_specifier", "struct"), t(";"), "\n", defs=[("struct", "{name}", 0, 1, 0)]),
    block(_c_function(ident("{name}", "declarator"), _c_return(_ARROW_CALL)), "\n\n",
          defs=[("function", "{name}", 0, 2, 0)], calls=[("{callee}", 1)]),
    block(n("declaration", leaf("primitive_type", "int", "type"), " ", ident("{name}", "declarator"), t(";")), "  ",
          leaf("comment", "/* int {name}() calls\n   {callee}() */"), "\n"),
]
CPP = [
    *C,
    block(_c_function(n("qualified_identifier", leaf("namespace_identifier", "T", "scope"), t("::"),
                        ident("{name}", "name"), field="declarator"),
                      _c_return(n("qualified_identifier", leaf("namespace_identifier", "m", "scope"), t("::"),
                                  ident("{callee}", "name"), field="function"))), "\n",
          defs=[("method", "T::{name}", 0, 2, 0)], calls=[("{callee}", 1)]),
    block(_c_record("class_specifier", "class"), t(";"), "\n", defs=[("class", "{name}", 0, 1, 0)]),
]


# ---------------------------------------------------------------- java
def _java_body(*kids):
    return n("block", t("{"), *kids, t("}"), field="body")


def _java_call():
    return n("method_invocation", ident("{callee}", "name"), n("argument_list", t("("), t(")"), field="arguments"))


JAVA = [
    block(n("import_declaration", t("import"), " ", n("scoped_identifier", ident("{module}", "scope"), t("."),
                                                    ident("Z", "name")), t(";")), "\n"),
    block(n("class_declaration", t("class"), " ", ident("{name}", "name"), " ",
            n("class_body", t("{"), "\n  ",
              n("constructor_declaration", ident("{name}", "name"),
                n("formal_parameters", t("("), t(")"), field="parameters"), " ",
                n("constructor_body", t("{"), " ", t("}"), field="body")), "\n  ",
              n("method_declaration", leaf("void_type", "void", "type"), " ", ident("run", "name"),
                n("formal_parameters", t("("), t(")"), field="parameters"), " ",
                _java_body(" ", n("expression_statement", _java_call(), t(";")), " ")), "\n",
              t("}"), field="body")), "\n",
          defs=[("class", "{name}", 0, 3, 0), ("constructor", "{name}", 1, 1, 1), ("method", "run", 2, 2, 2)],
          calls=[("{callee}", 2)]),
    block(n("interface_declaration", t("interface"), " ", ident("{name}", "name"), " ",
            n("interface_body", t("{"), "\n", t("}"), field="body")), "\n",
          defs=[("interface", "{name}", 0, 1, 0)]),
    block(leaf("line_comment", "// class {name} calls {callee}()"), "\n"),
]


# ---------------------------------------------------------------- ruby
def _ruby_block(kind, word, name_type):
    return block(n(kind, t(word), " ", leaf(name_type, "N{name}" if name_type == "constant" else "{name}", "name"),
                   "\n", t("end")), "\n",
                 defs=[(kind, "N{name}" if name_type == "constant" else "{name}", 0, 1, 0)])


RUBY = [
    block(leaf("comment", "# needs {module}"), "\n"),
    block(n("method", t("def"), " ", ident("{name}", "name"), "\n  ",
            n("body_statement", n("call", ident("{callee}", "method"),
                                  n("argument_list", t("("), leaf("integer", "1"), t(")"), field="arguments")),
              field="body"), "\n", t("end")), "\n", defs=[("method", "{name}", 0, 2, 0)], calls=[("{callee}", 1)]),
    _ruby_block("class", "class", "constant"),
    _ruby_block("module", "module", "constant"),
    block(leaf("comment", "# def {name} calls {callee}()"), "\n"),
]

# ---------------------------------------------------------------- bash
BASH = [
    block(leaf("comment", "# needs {module}"), "\n"),
    block(n("function_definition", leaf("word", "{name}", "name"), t("("), t(")"), " ",
            n("compound_statement", t("{"), "\n  ",
              n("command", n("command_name", leaf("word", "{callee}"), field="name"), " ", leaf("word", "x", "argument")),
              "\n", t("}"), field="body")), "\n", defs=[("function", "{name}", 0, 2, 0)], calls=[("{callee}", 1)]),
    block(leaf("comment", "# {name}() calls {callee}"), "\n"),
]


# ---------------------------------------------------------------- php
def _php_name(text, field=None):
    return leaf("name", text, field)


def _php_args():
    return n("arguments", t("("), t(")"), field="arguments")


def _php_body(*kids):
    return n("compound_statement", t("{"), "\n  ", *kids, "\n", t("}"), field="body")


def _php_function(*body):
    return n("function_definition", t("function"), " ", _php_name("{name}", "name"),
             n("formal_parameters", t("("), t(")"), field="parameters"), " ", _php_body(*body))


def _php_this():
    return n("variable_name", t("$"), _php_name("this"), field="object")


PHP = [
    block(leaf("php_tag", "<?php"), " ", leaf("comment", "// needs {module}"), "\n"),
    block(_php_function(n("expression_statement",
                          n("function_call_expression", _php_name("{callee}", "function"), _php_args()), t(";"))), "\n",
          defs=[("function", "{name}", 0, 2, 0)], calls=[("{callee}", 1)]),
    block(_php_function(n("expression_statement",
                          n("function_call_expression",
                            n("qualified_name",
                              n("namespace_name_as_prefix", n("namespace_name", _php_name("A")), t("\\")),
                              _php_name("{callee}"), field="function"), _php_args()), t(";"))), "\n",
          defs=[("function", "{name}", 0, 2, 0)], calls=[("{callee}", 1)]),
    block(n("class_declaration", t("class"), " ", _php_name("{name}", "name"), " ",
            n("declaration_list", t("{"), "\n  ",
              n("method_declaration", t("function"), " ", _php_name("run", "name"),
                n("formal_parameters", t("("), t(")"), field="parameters"), " ",
                n("compound_statement", t("{"), " ",
                  n("expression_statement",
                    n("member_call_expression", _php_this(), t("->"), _php_name("{callee}", "name"), _php_args()),
                    t(";")), " ",
                  n("expression_statement",
                    n("scoped_call_expression", _php_name("B", "scope"), t("::"), _php_name("{callee}", "name"),
                      _php_args()), t(";")), " ", t("}"), field="body")), "\n", t("}"), field="body")), "\n",
          defs=[("class", "{name}", 0, 2, 0), ("method", "run", 1, 1, 1)], calls=[("{callee}", 1), ("{callee}", 1)]),
    block(n("interface_declaration", t("interface"), " ", _php_name("{name}", "name"), " ",
            n("declaration_list", t("{"), "\n", t("}"), field="body")), "\n",
          defs=[("interface", "{name}", 0, 1, 0)]),
]

# Order = index by supplier key modulo 12. Item 0 of each list is the file header.
TEMPLATES = {
    "python": PYTHON, "javascript": JAVASCRIPT, "typescript": TYPESCRIPT, "tsx": TYPESCRIPT, "go": GO, "rust": RUST,
    "c": C, "cpp": CPP, "java": JAVA, "ruby": RUBY, "bash": BASH, "php": PHP,
}


@dataclass(frozen=True)
class Laid:
    """A template node with its place: offsets and rows relative to the template's start."""

    ix: int
    last_ix: int
    parent_ix: int | None
    depth: int
    child_ix: int
    node: Node
    start: tuple[int, int, int]     # offset, row, column
    end: tuple[int, int, int]


def text_of(template: Template) -> str:
    def walk(item) -> str:
        if isinstance(item, str):
            return item
        return item.text if item.text is not None else "".join(walk(k) for k in item.kids)

    return "".join(walk(i) for i in template.items)


def widened(text: str) -> str:
    for mark, real in PLACEHOLDERS.items():
        text = text.replace(mark, real)
    return text


def laid_out(template: Template) -> list[Laid]:
    rows: list[Laid] = []
    at = (0, 0, 0)

    def advance(text: str) -> None:
        nonlocal at
        text = widened(text)
        offset, row, col = at
        breaks = text.count("\n")
        at = (offset + len(text), row + breaks, len(text) - text.rfind("\n") - 1 if breaks else col + len(text))

    def place(item: Node, parent: int | None, depth: int, child_ix: int) -> None:
        ix, start = len(rows), at
        rows.append(None)
        if item.text is not None:
            advance(item.text)
        children(item.kids, ix, depth + 1)
        rows[ix] = Laid(ix, len(rows) - 1, parent, depth, child_ix, item, start, at)

    def children(items, parent: int | None, depth: int) -> None:
        count = 0
        for item in items:
            if isinstance(item, str):
                advance(item)
            else:
                place(item, parent, depth, count)
                count += 1

    children(template.items, None, 1)
    return rows

"""Column-expression building blocks (all JVM-side, codegen friendly)."""

from quillrank.functions.text import (
    WHITESPACE,
    clean_glued,
    clean_words,
    field,
    split_fields,
    token_array,
    token_array_glued,
)

__all__ = [
    "WHITESPACE",
    "clean_glued",
    "clean_words",
    "field",
    "split_fields",
    "token_array",
    "token_array_glued",
]

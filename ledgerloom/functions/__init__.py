from ledgerloom.functions.hashing import business_hash, canonical_columns, is_sha256
from ledgerloom.functions.money import add_amounts, to_basis_points, to_cents
from ledgerloom.functions.parsing import parse_number, parse_utc
from ledgerloom.functions.text import clean_text, collapse_spaces, python_repr, title_case

__all__ = [
    "add_amounts", "business_hash", "canonical_columns", "clean_text", "collapse_spaces", "is_sha256",
    "parse_number", "parse_utc", "python_repr", "title_case", "to_basis_points", "to_cents",
]

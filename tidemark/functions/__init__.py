from tidemark.functions.symbols import SYMBOLS, SymbolRule, split_symbols, symbol_list
from tidemark.functions.text import count_text, minute_text, number_text

__all__ = [
    "SYMBOLS",
    "SymbolRule",
    "count_text",
    "minute_text",
    "number_text",
    "split_symbols",
    "symbol_list",
]

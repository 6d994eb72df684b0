from .money import (CLEARING_CODE, NATURAL_PERSON, TAX_CODE, balance_code, converted, money,
                    narrow_money, product)
from .text import MODES, matches

__all__ = [
    "CLEARING_CODE", "NATURAL_PERSON", "TAX_CODE", "balance_code", "converted", "money",
    "narrow_money", "product", "MODES", "matches",
]

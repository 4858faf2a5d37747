from stratalake.functions.columns import MONEY, clean_text, day_string, money

__all__ = ["MONEY", "clean_text", "day_string", "money"]

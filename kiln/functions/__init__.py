from kiln.functions import dates, mathx, text

__all__ = ["dates", "mathx", "text"]

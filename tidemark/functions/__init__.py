"""Column expressions."""

from tidemark.functions.columns import average, duration_label, minutes, standard_name, title_text

__all__ = ["average", "duration_label", "minutes", "standard_name", "title_text"]

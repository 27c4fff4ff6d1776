"""Text outputs."""

from .text import tab_lines, write_csv_header, write_lines, write_tab_text

__all__ = ["tab_lines", "write_csv_header", "write_lines", "write_tab_text"]

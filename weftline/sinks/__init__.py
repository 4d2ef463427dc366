from weftline.sinks.text import write_binned, write_counted, write_lines, write_sorted_lines

__all__ = ["write_binned", "write_counted", "write_lines", "write_sorted_lines"]

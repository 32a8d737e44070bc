"""The 33 table builders (T1-T33) and their specs."""

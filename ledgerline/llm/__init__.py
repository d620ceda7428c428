"""Operators of a training-data pipeline: archives, packing, de-duplication,
decontamination, language ID, quality rules, URL filters and licence scans."""

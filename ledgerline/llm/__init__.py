"""Operators for preparing training data: near duplicates, archives, classifiers, search, token files, packing, scans."""

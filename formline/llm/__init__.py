"""Operators for training corpora: near duplicates, language, licences, secrets, mixing, packing, sharding, search, archives.

Nothing outside this package imports it. Executors need the package on their Python path (``--py-files``).
"""

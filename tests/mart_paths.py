"""Test tables; a module of its own name, because every folder's ``conftest`` is imported as ``conftest``."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MED = "/root/testdata/sf0.01"

"""Folders of the given test tables (a plain module: two test folders each have a ``conftest``)."""

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"

"""Folders of the test tables (a module of its own: test folders each have a ``conftest``)."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

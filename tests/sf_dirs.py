"""Folders of the driver's tables that the tests read."""

SF = "/root/testdata/sf0.001"

"""Table folder shared by the core tests."""

SF_SMALL = "/root/testdata/sf0.001"

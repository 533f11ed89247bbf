"""The smallest given tables."""

SF_SMALL = "/root/testdata/sf0.001"

"""Where the benchmark tables lie (a module of its own name: several folders have a conftest)."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

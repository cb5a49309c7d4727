"""Where the tests find the small tables; a module of its own, as every folder of tests may have a conftest."""

SF_SMALL = "/root/testdata/sf0.001"

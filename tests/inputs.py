"""Input tables of the tests; a module of its own, as every test folder has a conftest."""

SF_SMALL = "/root/testdata/sf0.001"

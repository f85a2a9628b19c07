"""Values that several tests use."""

FOLDER = "/root/testdata/sf0.001"

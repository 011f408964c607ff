"""What several tests of the training-data operators share."""

SMALL = "/root/testdata/sf0.001"

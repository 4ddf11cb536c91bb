"""Where the driver's tables lie."""

SF = "/root/testdata/sf0.01"
SF_SMALL = "/root/testdata/sf0.001"

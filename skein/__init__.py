"""skein: catalogue building, web-page analysis and crawl dataflows as PySpark DataFrame functions."""

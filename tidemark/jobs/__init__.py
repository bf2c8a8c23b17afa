"""Programs for spark-submit. None sets a master or resources: that is submit-time."""

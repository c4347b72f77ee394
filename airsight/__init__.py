"""airsight: environmental analytics as Spark DataFrame transformations."""

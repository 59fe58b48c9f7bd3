"""skein: instruction-dataset preparation and corpus operators expressed as Spark DataFrame plans."""

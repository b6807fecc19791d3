"""platewise: table analytics for simulated metal plates, written as Spark DataFrame functions."""

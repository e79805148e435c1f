"""omphalos: the most central member of each group of located points, on Spark."""

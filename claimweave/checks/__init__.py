"""The registered queries over the sample views and the SQL they are checked against."""

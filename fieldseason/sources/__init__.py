"""Tables, landed JSON files, reports and the views over the driver's tables."""

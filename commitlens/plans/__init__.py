"""What a user calls: the batch stages and the question service."""

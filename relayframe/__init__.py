"""Message-transfer analytics as DataFrame operators: framing, validation, routing,
capacity negotiation, chunking, reassembly, queues, change feeds and reports."""

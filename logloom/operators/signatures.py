"""Event hashes and function selectors of the token standards.

Fixed values (must equal the reference's constants; each is also recomputed by
``functions.keccak`` in the tests from its canonical signature).
"""

# Event topic0 hashes.
TRANSFER = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
APPROVAL = "0x8c5be1e5ebec7d5bd14f71427d1e84f3dd0314c0f7b2291e5b200ac8c7c3b925"
APPROVAL_FOR_ALL = "0x17307eab39ab6107e8899845ad3d59bd9653f200f220920489ca2b5937696c31"
TRANSFER_SINGLE = "0xc3d58168c5ae7397731d063d5bbf3d657854427343f4c083240f7aacaa2d0f62"
TRANSFER_BATCH = "0x4a39dc06d4c0dbc64b70af90fd698a233a518aa5d07e595d983b8c0526c8f7fb"
URI = "0x6bb7ff708619ba0610cba295a58592e0451dee2622938c8755667688daf3529b"

EVENT_SIGNATURES = {
    TRANSFER: "Transfer(address,address,uint256)",
    APPROVAL: "Approval(address,address,uint256)",
    APPROVAL_FOR_ALL: "ApprovalForAll(address,address,bool)",
    TRANSFER_SINGLE: "TransferSingle(address,address,address,uint256,uint256)",
    TRANSFER_BATCH: "TransferBatch(address,address,address,uint256[],uint256[])",
    URI: "URI(string,uint256)",
}
